"""An OData service as a Spark data source (#1-#9).

One input partition an id batch, or a range of a time column of an entity, found by counting, or the whole entity; its pages are followed one by one and
streamed out as rows, never held together.  Requests retry on 429 (as long as the service says), on 5xx, on
network errors and on truncated JSON; fetching is idempotent, so a task may be run again.  A request that the
service refuses as unauthorised is sent once more with a new token, where the reader can get one.  A task has
one request open at a time, so the number of tasks bounds the concurrent requests.
"""

from __future__ import annotations

import json
import re
import time
import urllib.error
import urllib.parse
import urllib.request
from collections import deque
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from datetime import datetime, timedelta, timezone

from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, EqualTo, Filter, GreaterThan, InputPartition

#: Fixed values of the protocol.
DELAYS = (1, 2, 4, 8, 16)
PAGE_SIZE = 5000
ANNOTATION = "OData.Community.Display.V1.FormattedValue"
TENANT = r'authorization_uri="?[^"\s]*?/([0-9a-f-]{36})/oauth2'
TOKEN_URL = "https://login.microsoftonline.com/{tenant}/oauth2/v2.0/token"
EXPIRES, REFRESH = 3599, 3000


class HttpError(RuntimeError):
    def __init__(self, status: int, text: str) -> None:
        super().__init__(f"the service answered {status}: {text}")
        self.status, self.text = status, text

    def __reduce__(self) -> tuple:  # a task's error travels to the driver
        return type(self), (self.status, self.text)


def _open(url: str, headers: dict[str, str], data: bytes | None = None, timeout: float = 60) -> tuple[int, dict[str, str], bytes]:
    try:
        with urllib.request.urlopen(urllib.request.Request(url, data, headers), timeout=timeout) as r:
            return r.status, dict(r.headers), r.read()
    except urllib.error.HTTPError as e:
        return e.code, dict(e.headers or {}), e.read()


@dataclass
class Client:
    """Requests with retries. transport(url, headers) -> (status, headers, body) may be put in place of the network."""

    base: str
    token: str | Callable[[], str] = ""
    transport: Callable[..., tuple[int, dict[str, str], bytes]] = _open
    sleep: Callable[[float], None] = time.sleep
    renew: Callable[[], str] | None = None

    def _headers(self, accept: str) -> dict[str, str]:
        token = self.token() if callable(self.token) else self.token
        return {"Authorization": f"Bearer {token}", "Accept": accept, "OData-MaxVersion": "4.0", "OData-Version": "4.0", "Prefer": f'odata.maxpagesize={PAGE_SIZE},odata.include-annotations="{ANNOTATION}"'}

    def fetch(self, url: str, accept: str = "application/json") -> object:
        problem, renewed = "", False
        for delay in (*DELAYS, None):
            wait = delay
            try:
                status, headers, body = self.transport(url, self._headers(accept))
            except (OSError, TimeoutError) as e:
                problem = f"no connection ({e})"
            else:
                if status == 200:
                    if accept != "application/json":
                        return body.decode("utf-8")
                    try:
                        return json.loads(body)
                    except ValueError as e:
                        problem = f"the answer is no JSON ({e})"
                elif status == 401:
                    if self.renew is None or renewed:
                        raise HttpError(status, "the service does not accept this token")
                    self.renew()
                    renewed, problem, wait = True, "the token was refused", 0 if delay is not None else None
                elif status == 429:
                    problem = "the service asks to wait"
                    told = {k.lower(): v for k, v in headers.items()}.get("retry-after", "")
                    wait = int(told) if delay is not None and told.strip().isdigit() else delay
                elif status >= 500:
                    problem = f"the service failed with {status}: {body[:500]!r}"
                else:
                    raise HttpError(status, body.decode("utf-8", "replace"))
            if wait is None:
                break
            self.sleep(wait)
        raise RuntimeError(f"{problem}; no more tries after {len(DELAYS) + 1} attempts")

    def url(self, entity: str, **options: str | None) -> str:
        told = {f"${k}": v for k, v in options.items() if v}
        return f"{self.base}/{entity}" + ("?" + urllib.parse.urlencode(told, quote_via=urllib.parse.quote) if told else "")

    def pages(self, entity: str, orderby: str | None = None, filter: str | None = None, select: str | None = None) -> Iterator[list[dict]]:
        """The pages of an entity; if the service refuses the order, one page without it, and an error if there are more."""
        url = self.url(entity, orderby=orderby, filter=filter, select=select)
        try:
            got = self.fetch(url)
        except HttpError as e:
            if not (orderby and e.status == 400 and re.search("orderby|attribute|principal", e.text, re.IGNORECASE)):
                raise
            got = self.fetch(self.url(entity, filter=filter, select=select))
            yield got.get("value", [])
            if "@odata.nextLink" in got:
                raise RuntimeError(f"{entity}: more pages, but the service gives no order to page by") from e
            return
        while True:
            yield got.get("value", [])
            if not (link := got.get("@odata.nextLink")):
                return
            got = self.fetch(link)

    def count(self, entity: str, filter: str | None = None) -> int:
        return int(self.fetch(self.url(f"{entity}/$count", filter=filter), "text/plain").strip().lstrip("﻿"))

    def edge(self, entity: str, column: str, way: str, filter: str | None = None) -> str | None:
        """The least (asc) or largest (desc) value of a column that is not null."""
        got = self.fetch(self.url(entity, select=column, orderby=f"{column} {way}", top="1", filter=both(filter, f"{column} ne null"))).get("value", [])
        return got[0].get(column) if got else None

    def metadata(self) -> str:
        return self.fetch(f"{self.base}/$metadata", "application/xml")


@dataclass
class Authenticator:
    """Client-credentials tokens; the tenant is discovered from the service's challenge."""

    api_url: str
    client_id: str
    client_secret: str
    scope: str
    refresh_window: float = REFRESH
    transport: Callable[..., tuple[int, dict[str, str], bytes]] = _open
    clock: Callable[[], float] = time.time
    tenant: str | None = None
    token: str | None = None
    expiry: float = 0.0

    def discover(self) -> str:
        _, headers, _ = self.transport(self.api_url, {"Accept": "application/json"})
        challenge = {k.lower(): v for k, v in headers.items()}.get("www-authenticate", "")
        if not challenge:
            raise RuntimeError(f"{self.api_url} sends no WWW-Authenticate challenge to find the tenant in")
        m = re.search(TENANT, challenge, re.IGNORECASE)
        if not m:
            raise RuntimeError(f"the challenge of {self.api_url} names no tenant: {challenge}")
        return m[1]

    def authenticate(self) -> str:
        self.tenant = self.tenant or self.discover()
        form = {"client_id": self.client_id, "client_secret": self.client_secret, "scope": self.scope, "grant_type": "client_credentials"}
        status, _, body = self.transport(TOKEN_URL.format(tenant=self.tenant), {"Content-Type": "application/x-www-form-urlencoded"}, urllib.parse.urlencode(form).encode())
        got = json.loads(body) if status == 200 else {}
        if not got.get("access_token"):
            raise RuntimeError(f"no token: the sign-in answered {status}")
        self.token, self.expiry = got["access_token"], self.clock() + got.get("expires_in", EXPIRES)
        return self.token

    def get_token(self) -> str:
        if not self.token or self.clock() >= self.expiry - self.refresh_window:
            self.authenticate()
        return self.token


def both(*filters: str | None) -> str | None:
    own = [f for f in filters if f]
    return " and ".join(f"({f})" for f in own) if len(own) > 1 else "".join(own) or None


def ranges(client: Client, entity: str, column: str, parts: int, filter: str | None = None, most: int = PAGE_SIZE) -> list[str | None]:
    """Filters of at most `parts` ranges of a time column, and of its nulls, that together select what `filter` does, each row once.

    Ranges are halved, the oldest of those in question first, while they count `most` rows or more (services stop counting at a page); the first has no lower bound and the last
    no upper one, so rows that change meanwhile are not missed.
    """
    if parts < 2:
        return [filter]
    try:
        if client.count(entity, filter) < most:
            return [filter]
    except (RuntimeError, ValueError):  # a service that does not count is read whole
        return [filter]
    ends = [client.edge(entity, column, way, filter) for way in ("asc", "desc")]
    if None in ends:
        return [filter]
    try:
        first, last = (datetime.fromisoformat(x) for x in ends)
    except ValueError:  # no times after all
        return [filter]
    text = lambda t: t.strftime("%Y-%m-%dT%H:%M:%SZ")
    whole = lambda t: (t if t.tzinfo else t.replace(tzinfo=timezone.utc)).astimezone(timezone.utc).replace(microsecond=0)
    todo, done = deque([(whole(first), whole(last) + timedelta(seconds=1))]), []
    while todo:
        a, b = todo.popleft()
        middle = a + timedelta(seconds=(b - a) // timedelta(seconds=2))
        if middle > a and len(todo) + len(done) + 2 <= parts and client.count(entity, both(filter, f"{column} ge {text(a)}", f"{column} lt {text(b)}")) >= most:
            todo += [(a, middle), (middle, b)]
        else:
            done.append(a)
    starts = sorted(done)
    bounds = [(None if n == 0 else a, starts[n + 1] if n + 1 < len(starts) else None) for n, a in enumerate(starts)]
    told = [both(filter, a and f"{column} ge {text(a)}", b and f"{column} lt {text(b)}") for a, b in bounds]
    # comparisons leave nulls out; where one range is left it has no comparison
    return [*told, both(filter, f"{column} eq null")] if len(told) > 1 else [filter]


def client_of(options: dict[str, str]) -> Client:
    """A client by the source's options: with credentials (client_id, client_secret, scope) it gets its own tokens, else it keeps `token`."""
    base = options["url"].rstrip("/")
    if not options.get("client_id"):
        return Client(base, options.get("token", ""))
    auth = Authenticator(base, options["client_id"], options.get("client_secret", ""), options.get("scope", ""), tenant=options.get("tenant") or None)
    auth.token, auth.expiry = options.get("token") or None, float(options.get("expiry") or 0)
    return Client(base, auth.get_token, renew=auth.authenticate)


class Batch(InputPartition):
    def __init__(self, filter: str | None, number: int = 0) -> None:
        self.filter, self.number = filter, number


class Reader(DataSourceReader):
    """Rows (entity, seq, raw, modifiedon) of the entity that the options name; seq counts within a partition, and partitions follow one another."""

    def __init__(self, options: dict) -> None:
        self.options = options
        self.pushed: list[str] = []

    def partitions(self) -> list[Batch]:
        batches = json.loads(self.options.get("filters", "[]")) or [self.options.get("filter")]
        filters = [both(b, *self.pushed) for b in batches]
        if self.options.get("ranges") and len(filters) == 1:
            filters = ranges(client_of(self.options), self.options["entity"], self.options.get("rangecolumn", "modifiedon"), int(self.options["ranges"]), filters[0], int(self.options.get("rangerows", PAGE_SIZE)))
        return [Batch(f, n) for n, f in enumerate(filters)]

    def read(self, partition: Batch) -> Iterator[tuple]:
        o = self.options
        seq = partition.number << 40
        for page in client_of(o).pages(o["entity"], o.get("orderby"), partition.filter, o.get("select")):
            for record in page:
                yield o["entity"], seq, json.dumps(record), record.get("modifiedon")
                seq += 1


class PushingReader(Reader):
    """A reader to which Spark hands filters: `modifiedon > t` becomes part of the request, and `entity = e` is always so. Every other filter, and for safety `modifiedon > t` too, Spark applies as well."""

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        for f in filters:
            if isinstance(f, EqualTo) and f.attribute == ("entity",) and f.value == self.options.get("entity"):
                continue
            if isinstance(f, GreaterThan) and f.attribute == ("modifiedon",):
                self.pushed.append(f"modifiedon gt {f.value}")
            yield f


class ChangeReader(DataSourceStreamReader):
    """The changes of an entity as a stream: an offset is the largest `modifiedon` seen, a batch the records from the one offset to the next.

    Both ends are in the batch, since records of the offset's own time may come after it was read: these come again with the next batch,
    which a merge by key takes for no change.  Offsets are in the stream's checkpoint, so a batch that was read but not
    committed is read again, with the same bounds.  Records without the time are not in the stream.
    """

    def __init__(self, options: dict) -> None:
        self.options = options

    def initialOffset(self) -> dict:
        return {"mark": self.options.get("since", "")}

    def latestOffset(self) -> dict:
        o = self.options
        return {"mark": client_of(o).edge(o["entity"], "modifiedon", "desc", o.get("filter")) or o.get("since", "")}

    def partitions(self, start: dict, end: dict) -> list[Batch]:
        if not end["mark"]:
            return []
        # a record of the mark that the caller gives has been read already
        after = start["mark"] and f"modifiedon {'gt' if start == self.initialOffset() else 'ge'} {start['mark']}"
        return [Batch(both(self.options.get("filter"), after, f"modifiedon le {end['mark']}"))]

    def read(self, partition: Batch) -> Iterator[tuple]:
        return Reader(self.options).read(partition)

    def commit(self, end: dict) -> None:
        """Nothing is kept at the service."""


class ODataSource(DataSource):
    """spark.read.format("odata"), or readStream for the changes after `since`, with url, entity, orderby, filter or filters (a JSON list, one partition each), select, ranges (so many partitions at most by ranges of rangecolumn, each of rangerows rows or more), and token or credentials. pushdown=true hands Spark's filters to the service; Spark refuses that unless register() has switched it on."""

    @classmethod
    def name(cls) -> str:
        return "odata"

    def schema(self) -> str:
        return "entity string, seq long, raw string, modifiedon string"

    def streamReader(self, schema) -> ChangeReader:
        return ChangeReader(dict(self.options))

    def reader(self, schema) -> Reader:
        options = dict(self.options)
        return (PushingReader if str(options.get("pushdown")).lower() == "true" else Reader)(options)


def register(spark: SparkSession) -> None:
    """Makes the format known to the session, with filter pushdown into Python sources, which is off by default."""
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(ODataSource)
