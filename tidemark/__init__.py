"""A typed, historised copy of an operational source on Spark, and questions to it."""

__all__ = ["run_sync", "run_workflow"]


def __getattr__(name: str):
    # late, so that executors that need one module load no more than that
    if name in __all__:
        from .plans import workflow

        return getattr(workflow, name)
    raise AttributeError(name)
