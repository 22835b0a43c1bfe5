"""The type system: EDM types to database and Spark types, and normal forms of database types."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: EDM type, SQLite type, PostgreSQL type.
EDM_TYPES = (
    ("Edm.String", "TEXT", "VARCHAR"),
    ("Edm.Int16", "INTEGER", "SMALLINT"),
    ("Edm.Int32", "INTEGER", "INTEGER"),
    ("Edm.Int64", "INTEGER", "BIGINT"),
    ("Edm.Decimal", "REAL", "NUMERIC"),
    ("Edm.Double", "REAL", "DOUBLE PRECISION"),
    ("Edm.Boolean", "INTEGER", "BOOLEAN"),
    ("Edm.DateTimeOffset", "TEXT", "TIMESTAMP WITH TIME ZONE"),
    ("Edm.Date", "TEXT", "DATE"),
    ("Edm.TimeOfDay", "TEXT", "TIME"),
    ("Edm.Guid", "TEXT", "UUID"),
    ("Edm.Binary", "BLOB", "BYTEA"),
)
DIALECTS = {"sqlite": "sqlite", "postgresql": "postgresql", "postgres": "postgresql"}
#: Normal form, then the names that mean it, by dialect.
ALIASES = {
    "sqlite": {
        "TEXT": ["VARCHAR", "CHAR", "NVARCHAR", "NCHAR", "CLOB"],
        "INTEGER": ["INT", "TINYINT", "SMALLINT", "MEDIUMINT", "BIGINT"],
        "REAL": ["DOUBLE", "FLOAT", "NUMERIC", "DECIMAL"],
        "BLOB": ["BINARY", "VARBINARY"],
    },
    "postgresql": {
        "TEXT": ["CHARACTER VARYING", "CHAR", "CHARACTER", "VARCHAR"],
        "INTEGER": ["INT", "INT4"],
        "SMALLINT": ["INT2"],
        "BIGINT": ["INT8"],
        "DOUBLE PRECISION": ["FLOAT8"],
        "REAL": ["FLOAT4"],
        "BOOLEAN": ["BOOL"],
        "TIMESTAMP WITH TIME ZONE": ["TIMESTAMPTZ"],
    },
}


def _dialect(name: str) -> str:
    try:
        return DIALECTS[name.lower()]
    except KeyError:
        raise ValueError(f"Unsupported database type: {name}") from None


def db_type(edm_type: str, dialect: str = "sqlite", max_length: int | None = None, is_option_set: bool = False) -> str:
    """The database type of an EDM type; coded strings are integers in any dialect, unknown types are TEXT."""
    if is_option_set and edm_type == "Edm.String":
        return "INTEGER"
    postgres = _dialect(dialect) == "postgresql"
    found = {e: p if postgres else s for e, s, p in EDM_TYPES}.get(edm_type, "TEXT")
    if found == "VARCHAR":
        return f"VARCHAR({max_length})" if max_length else "TEXT"
    return found


def db_type_col(edm_type: Column, max_length: Column, is_option_set: Column, dialect: str = "sqlite") -> Column:
    """db_type() as a column expression."""
    postgres = _dialect(dialect) == "postgresql"
    table = F.create_map(*[F.lit(x) for e, s, p in EDM_TYPES for x in (e, p if postgres else s)])
    base = F.coalesce(F.try_element_at(table, edm_type), F.lit("TEXT"))
    if postgres:
        sized = F.when(max_length > 0, F.concat(F.lit("VARCHAR("), max_length.cast("string"), F.lit(")"))).otherwise("TEXT")
        base = F.when(base == "VARCHAR", sized).otherwise(base)
    return F.when(is_option_set & (edm_type == "Edm.String"), "INTEGER").otherwise(base)


def _alias_pairs(dialect: str) -> list[tuple[str, str]]:
    kinds = ALIASES.get(DIALECTS.get(dialect.lower(), ""), {})
    return [(alias, normal) for normal, names in kinds.items() for alias in names]


def normal_type(name: str, dialect: str = "sqlite") -> str:
    """Upper case, no length, alias replaced; an unknown dialect knows no aliases."""
    clean = name.upper().strip().split("(")[0].strip()
    return dict(_alias_pairs(dialect)).get(clean, clean)


def normal_type_col(name: Column, dialect: str = "sqlite") -> Column:
    clean = F.trim(F.split_part(F.trim(F.upper(name)), F.lit("("), F.lit(1)))
    pairs = _alias_pairs(dialect)
    if not pairs:
        return clean
    return F.coalesce(F.try_element_at(F.create_map(*[F.lit(x) for p in pairs for x in p]), clean), clean)


#: Spark types of EDM types; strict ones for new code, those of the untyped store otherwise.
STRICT = {
    "Edm.Int16": T.ShortType(), "Edm.Int32": T.IntegerType(), "Edm.Int64": T.LongType(), "Edm.Decimal": T.DecimalType(38, 10),
    "Edm.Double": T.DoubleType(), "Edm.Boolean": T.BooleanType(), "Edm.Date": T.DateType(), "Edm.Binary": T.BinaryType(),
}
STORED = {"INTEGER": T.LongType(), "REAL": T.DoubleType(), "BLOB": T.BinaryType()}


def spark_type(edm_type: str, is_option_set: bool = False, strict: bool = False) -> T.DataType:
    if is_option_set and edm_type == "Edm.String":
        return T.LongType()
    if strict:
        return STRICT.get(edm_type, T.StringType())
    return STORED.get(db_type(edm_type), T.StringType())
