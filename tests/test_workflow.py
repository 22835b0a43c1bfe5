import json
import re
import threading
import time
import urllib.parse
from http.server import BaseHTTPRequestHandler, ThreadingHTTPServer

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.model import EntityConfig
from tidemark.operators.optionsets import SUFFIX
from tidemark.plans import cli, workflow
from tidemark.sources import odata
from tidemark.sources.store import Conflict, Store
from tidemark.streaming import feed

from .test_metadata import DOCUMENT

VESSELS = EntityConfig("vessel", "vessels")
PILOTS = EntityConfig("pilot", "pilots", filtered=True)


def raw(spark, *records):
    return spark.createDataFrame([(i, json.dumps(r)) for i, r in enumerate(records)], "seq long, raw string")


def vessel(n, name, status, label, day, **more):
    return {"vesselid": f"a{n}", "callsign": name, "berthstate": status, f"berthstate{SUFFIX}": label, "modifiedon": day, "@odata.etag": f"W/{day}", **more}


def cargoes(codes, labels):
    return {"cargoes": codes, f"cargoes{SUFFIX}": labels}


def test_full_then_incremental_then_closed(spark, tmp_path):
    store = Store(spark, str(tmp_path / "store"))
    users = raw(spark, *({"pilotid": f"u{i}", "badge": f"U{i}"} for i in (1, 2, 3)))
    first = raw(spark, vessel(1, "Aurora", 1, "Moored", "2024-01-15", _pilot_value="u1", **cargoes("1,2,3", "Grain;Steel;Fruit")), vessel(2, "Grebe", 2, "Away", "2024-01-20", _pilot_value="u2", **cargoes("2,4", "Steel;Coal")), {"vesselid": "", "callsign": "no key"})
    source = workflow.RawSource(DOCUMENT, {"vessels": first, "pilots": users})
    got = workflow.run_workflow(store, source, [VESSELS, PILOTS], verify_references=True, clock="2024-01-31")
    assert got["success"] and got["total_added"] == 4 and got["total_updated"] == 0, got
    assert sorted(r[0] for r in store.read("pilots").select("pilotid").collect()) == ["u1", "u2"]
    state = {r["entity_name"]: r for r in store.read("_sync_state").collect()}
    assert state["vessels"]["state"] == "completed" and state["vessels"]["last_timestamp"] == "2024-01-20" and state["vessels"]["records_count"] == 3
    links = store.read("_junction_vessels_cargoes")
    assert sorted((r["entity_id"], r["option_code"]) for r in links.where("valid_to is null").collect()) == [("a1", 1), ("a1", 2), ("a1", 3), ("a2", 2), ("a2", 4)]

    second = raw(spark, vessel(1, "Aurora II", 3, "Waiting", "2024-02-01", _pilot_value="u9", **cargoes("3,4", "Fruit;Coal")), vessel(2, "Grebe", 2, "Away", "2024-01-20", _pilot_value="u2", **cargoes("2,4", "Steel;Coal")))
    source.records["vessels"] = second
    got = workflow.run_workflow(store, source, [VESSELS, PILOTS], verify_references=True, clock="2024-02-02")
    assert (got["total_added"], got["total_updated"]) == (0, 1) and not got["success"]
    assert [(r["fk_col"], r["dangling_count"]) for r in got["reference_errors"]] == [("_pilot_value", 1)]
    rows = store.read("vessels")
    assert rows.count() == 3 and rows.where("valid_to is null").count() == 2
    assert rows.where("valid_to is not null").first()["valid_to"] == "2024-02-01"
    assert sorted(r["row_id"] for r in rows.collect()) == [1, 2, 3]
    links = store.read("_junction_vessels_cargoes").where("entity_id = 'a1'")
    assert sorted(r["option_code"] for r in links.where("valid_to is null").collect()) == [3, 4] and links.count() == 5
    lookup = store.read("_optionset").where("field = 'berthstate'")
    assert sorted((r["code"], r["label"], r["first_seen"]) for r in lookup.collect()) == [(1, "Moored", "2024-01-31"), (2, "Away", "2024-01-31"), (3, "Waiting", "2024-02-02")]
    assert store.read("_sync_log").where("status = 'completed'").count() >= 3

    out = tmp_path / "o.json"
    assert cli.main(["optionset-config", "--store", str(tmp_path / "store"), "--output", str(out)], spark) == 0
    assert json.loads(out.read_text())["vessels"] == ["berthstate"]
    entities = tmp_path / "e.json"
    entities.write_text(json.dumps({"entities": [{"name": "vessel"}, {"name": "pilot", "filtered": True}]}))
    (tmp_path / "m.xml").write_text(DOCUMENT)
    told = ["validate", "--store", str(tmp_path / "store"), "--entities", str(entities), "--metadata", str(tmp_path / "m.xml"), "--json", str(tmp_path / "r.json")]
    assert cli.main(told, spark) == 0
    # a changed type stops the next sync
    source.document = DOCUMENT.replace('Name="callsign" Type="Edm.String" MaxLength="12"', 'Name="callsign" Type="Edm.Int32"')
    got = workflow.run_workflow(store, source, [VESSELS, PILOTS])
    assert not got["success"] and [e["issue_type"] for e in got["validation_errors"]] == ["type_mismatch"]


def test_one_failure_does_not_stop_the_others(spark, tmp_path):
    store = Store(spark, str(tmp_path / "store"))
    source = workflow.RawSource(DOCUMENT, {"pilots": raw(spark, {"pilotid": "u1"})})
    got = workflow.run_workflow(store, source, [VESSELS, EntityConfig("pilot", "pilots")])
    assert [f[0] for f in got["failed_entities"]] == ["vessels"] and got["total_added"] == 1 and not got["success"]
    assert store.read("_sync_state").where("state = 'failed'").count() == 1


def test_a_failed_filtered_entity_is_tried_again_each_round(spark, tmp_path):
    class Failing(workflow.RawSource):
        left = 1

        def by_ids(self, *args):
            if self.left:
                self.left -= 1
                raise RuntimeError("down")
            return super().by_ids(*args)

    vessels = raw(spark, vessel(1, "Aurora", 1, "Moored", "2024-01-15", _pilot_value="u1"))
    source = Failing(DOCUMENT, {"vessels": vessels, "pilots": raw(spark, {"pilotid": "u1"}, {"pilotid": "u2"})})
    store = Store(spark, str(tmp_path / "store"))
    got = workflow.run_workflow(store, source, [VESSELS, PILOTS])
    assert got["failed_entities"] == [("pilots", "down")] and not got["success"] and got["total_added"] == 2
    assert [r[0] for r in store.read("pilots").select("pilotid").collect()] == ["u1"]
    source.left = 99  # one failure a round
    got = workflow.run_workflow(Store(spark, str(tmp_path / "other")), source, [VESSELS, PILOTS], rounds=3)
    assert got["failed_entities"] == [("pilots", "down")] * 3


class Service:
    """A transport with scripted answers."""

    def __init__(self, *answers):
        self.answers, self.urls = list(answers), []

    def __call__(self, url, headers, data=None):
        self.urls.append(urllib.parse.unquote(url))
        got = self.answers.pop(0)
        if isinstance(got, Exception):
            raise got
        status, head, body = got
        return status, head, body if isinstance(body, bytes) else json.dumps(body).encode()


def client(*answers):
    waits = []
    s = Service(*answers)
    return odata.Client("http://h", "t", s, waits.append), s, waits


def test_paging_and_retries():
    c, s, waits = client((429, {"Retry-After": "7"}, b""), (503, {}, b""), OSError("down"), (200, {}, b'{"value": [1'), (200, {}, {"value": [1], "@odata.nextLink": "http://h/next"}), (200, {}, {"value": [2]}))
    assert list(c.pages("vessels", "id", "a gt 1", "x")) == [[1], [2]]
    assert waits == [7, 2, 4, 8] and s.urls[0] == "http://h/vessels?$orderby=id&$filter=a gt 1&$select=x" and s.urls[-1] == "http://h/next"
    with pytest.raises(RuntimeError, match="after 6 attempts"):
        client(*[(500, {}, b"")] * 6)[0].fetch("http://h/x")
    with pytest.raises(RuntimeError, match="does not accept"):
        client((401, {}, b""))[0].fetch("http://h/x")
    c, s, _ = client((400, {}, b"bad orderby"), (200, {}, {"value": [3]}))
    assert list(c.pages("links", "id")) == [[3]] and "orderby" not in s.urls[1]
    c, _, _ = client((400, {}, b"bad orderby"), (200, {}, {"value": [3], "@odata.nextLink": "x"}))
    with pytest.raises(RuntimeError, match="more pages"):
        list(c.pages("links", "id"))
    assert client((200, {}, b"12"))[0].count("vessels") == 12
    # a refused token is renewed once
    c, _, waits = client((401, {}, b""), (200, {}, {"value": []}))
    c.token, c.renew = "old", lambda: setattr(c, "token", "new")
    assert c.fetch("http://h/x") == {"value": []} and c.token == "new"
    c, _, _ = client((401, {}, b""), (401, {}, b""))
    c.renew = lambda: "same"
    with pytest.raises(odata.HttpError):
        c.fetch("http://h/x")


def test_tokens():
    tenant = "12345678-1234-1234-1234-123456789abc"
    challenge = {"WWW-Authenticate": f'Bearer authorization_uri="https://login.example/{tenant}/oauth2/authorize"'}
    now = [0.0]
    s = Service((401, challenge, b""), (200, {}, {"access_token": "one", "expires_in": 3600}), (200, {}, {"access_token": "two"}))
    auth = odata.Authenticator("http://h", "i", "s", "q", transport=s, clock=lambda: now[0])
    assert auth.get_token() == "one" and auth.tenant == tenant and auth.get_token() == "one"
    now[0] = 601
    assert auth.get_token() == "two"
    with pytest.raises(RuntimeError, match="WWW-Authenticate"):
        odata.Authenticator("http://h", "i", "s", "q", transport=Service((200, {}, b""))).get_token()


def test_reader_partitions():
    r = odata.Reader({"entity": "a", "url": "u", "filters": '["k eq 1", "k eq 2"]'})
    assert [p.filter for p in r.partitions()] == ["k eq 1", "k eq 2"]
    assert [p.filter for p in odata.Reader({"entity": "a", "url": "u"}).partitions()] == [None]


@pytest.fixture
def service():
    """A service on this machine: records by entity, three a page, with the filters that the engine sends."""

    class Handler(BaseHTTPRequestHandler):
        records, asked, open_now, most_open, lock = {}, [], 0, 0, threading.Lock()

        def do_GET(self):
            cls = type(self)
            with cls.lock:
                cls.open_now += 1
                cls.most_open = max(cls.most_open, cls.open_now)
            try:
                self.answer()
            finally:
                with cls.lock:
                    cls.open_now -= 1

        def answer(self):
            path, _, query = self.path.partition("?")
            told = dict(urllib.parse.parse_qsl(query))
            name = path.strip("/")
            type(self).asked.append((name, told))
            if name == "$metadata":
                return self.send(DOCUMENT.encode())
            if name.endswith("/$count"):
                return self.send(str(len(type(self).records[name.split("/")[0]])).encode())
            rows = type(self).records[name]
            wanted = told.get("$filter", "")
            if mark := re.search(r"modifiedon gt (\S+?)\)?$", wanted):
                rows = [r for r in rows if r.get("modifiedon", "") > mark[1]]
            if ids := re.findall(r" eq '([^']*)'", wanted):
                rows = [r for r in rows if r["pilotid"] in ids]
            at = int(told.get("at", 0))
            page = {"value": rows[at : at + 3]}
            if at + 3 < len(rows):
                page["@odata.nextLink"] = f"http://127.0.0.1:{self.server.server_port}{path}?" + urllib.parse.urlencode({**told, "at": at + 3})
            self.send(json.dumps(page).encode())

        def send(self, body):
            self.send_response(200)
            self.send_header("Content-Length", str(len(body)))
            self.end_headers()
            self.wfile.write(body)

        def log_message(self, *args):
            pass

    server = ThreadingHTTPServer(("127.0.0.1", 0), Handler)
    threading.Thread(target=server.serve_forever, daemon=True).start()
    yield f"http://127.0.0.1:{server.server_port}", Handler
    server.shutdown()


def test_spark_reads_a_service(spark, service):
    url, handler = service
    handler.records["vessels"] = [vessel(i, f"V{i}", 1, "Moored", f"2024-01-0{i}") for i in range(1, 8)]
    odata.register(spark)
    read = lambda **more: spark.read.format("odata").options(url=url, entity="vessels", token="t", **more).load()
    rows = read(orderby="vesselid").collect()
    assert [json.loads(r["raw"])["vesselid"] for r in sorted(rows, key=lambda r: r["seq"])] == [f"a{i}" for i in range(1, 8)]
    late = read(pushdown="true").where("modifiedon > '2024-01-05' and entity = 'vessels'").collect()
    assert sorted(r["modifiedon"] for r in late) == ["2024-01-06", "2024-01-07"]
    assert any(t.get("$filter") == "modifiedon gt 2024-01-05" for _, t in handler.asked)
    parts = read(filters=json.dumps(["modifiedon gt 2024-01-06", "modifiedon gt 2024-01-05"]))
    assert parts.count() == 3 and parts.rdd.getNumPartitions() == 2


def test_an_entity_is_read_in_ranges_at_once(spark):
    """A service with counts, edges and ranges, of 200 records over 90 days, some at one time and some without one."""
    days = [f"2024-0{1 + i % 3}-{1 + i % 28:02}T{i % 24:02}:00:00Z" for i in range(150)] + ["2024-02-02T02:02:02Z"] * 40 + [None] * 10
    records = [{"vesselid": f"v{i:03}", "modifiedon": d} for i, d in enumerate(days)]

    def holds(r, told):
        found = re.findall(r"modifiedon (ge|lt|gt|eq|ne) ([^\s)]+)", told or "")
        m = r["modifiedon"]
        test = {"ge": lambda x: m is not None and m >= x, "lt": lambda x: m is not None and m < x, "gt": lambda x: m is not None and m > x, "eq": lambda x: m is None, "ne": lambda x: m is not None}
        return all(test[op](x) for op, x in found)

    class Handler(BaseHTTPRequestHandler):
        open_now, most_open, lock = 0, 0, threading.Lock()

        def do_GET(self):
            cls = type(self)
            with cls.lock:
                cls.open_now += 1
                cls.most_open = max(cls.most_open, cls.open_now)
            path, _, query = self.path.partition("?")
            told = dict(urllib.parse.parse_qsl(query))
            rows = [r for r in records if holds(r, told.get("$filter"))]
            if path.endswith("/$count"):
                body = str(min(len(rows), 20)).encode()  # it counts no further than a page
            else:
                time.sleep(0.05)
                if "$top" in told:
                    rows = sorted(rows, key=lambda r: r["modifiedon"], reverse=told["$orderby"].endswith("desc"))[:1]
                at = int(told.get("at", 0))
                page = {"value": rows[at : at + 20]}
                if at + 20 < len(rows):
                    page["@odata.nextLink"] = f"http://127.0.0.1:{self.server.server_port}{path}?" + urllib.parse.urlencode({**told, "at": at + 20})
                body = json.dumps(page).encode()
            with cls.lock:
                cls.open_now -= 1
            self.send_response(200)
            self.send_header("Content-Length", str(len(body)))
            self.end_headers()
            self.wfile.write(body)

        def log_message(self, *args):
            pass

    server = ThreadingHTTPServer(("127.0.0.1", 0), Handler)
    threading.Thread(target=server.serve_forever, daemon=True).start()
    odata.register(spark)
    read = lambda **more: spark.read.format("odata").options(url=f"http://127.0.0.1:{server.server_port}", entity="vessels", token="t", orderby="vesselid", **more).load()
    one, many = read(), read(ranges="12", rangerows="20")
    assert one.rdd.getNumPartitions() == 1 and 4 <= many.rdd.getNumPartitions() <= 13
    Handler.most_open = 0
    rows = many.collect()
    assert 1 < Handler.most_open <= 4  # as many as there are cores in the test
    assert sorted(r["raw"] for r in rows) == sorted(r["raw"] for r in one.collect()) and len({r["seq"] for r in rows}) == len(records)
    late = read(ranges="12", rangerows="20", pushdown="true").where("modifiedon > '2024-02-02T02:02:02Z'")
    assert sorted(r["modifiedon"] for r in late.collect()) == sorted(d for d in days if d and d > "2024-02-02T02:02:02Z")
    client = odata.Client(f"http://127.0.0.1:{server.server_port}", "t")
    assert odata.ranges(client, "vessels", "modifiedon", 12, most=300) == [None] and odata.ranges(client, "vessels", "modifiedon", 1) == [None]
    assert odata.ranges(client, "vessels", "modifiedon", 12, "modifiedon eq null", 5) == ["modifiedon eq null"]
    server.shutdown()


def test_changes_of_a_service_as_a_stream(spark, tmp_path, monkeypatch):
    """Each record once in the history, though a run fails before it reads, and one after its commit; records of the mark's own time that come late are not lost."""
    records = []

    class Handler(BaseHTTPRequestHandler):
        def do_GET(self):
            told = dict(urllib.parse.parse_qsl(self.path.partition("?")[2]))
            test = {"ge": lambda m, x: m >= x, "gt": lambda m, x: m > x, "le": lambda m, x: m <= x, "ne": lambda m, x: True}
            rows = [r for r in records if all(test[op](r["modifiedon"], x) for op, x in re.findall(r"modifiedon (ge|gt|le|ne) ([^\s)]+)", told.get("$filter", "")))]
            if "$top" in told:
                rows = sorted(rows, key=lambda r: r["modifiedon"], reverse=True)[:1]
            body = json.dumps({"value": rows}).encode()
            self.send_response(200)
            self.send_header("Content-Length", str(len(body)))
            self.end_headers()
            self.wfile.write(body)

        def log_message(self, *args):
            pass

    server = ThreadingHTTPServer(("127.0.0.1", 0), Handler)
    threading.Thread(target=server.serve_forever, daemon=True).start()
    store, apply = Store(spark, str(tmp_path / "store")), feed.apply_batch

    def run():
        changes = feed.changes(spark, "vesselid", {"vesselid": T.StringType(), "callsign": T.StringType()}, "now", url=f"http://127.0.0.1:{server.server_port}", entity="vessels", token="t")
        feed.history_stream(changes, store, "vessels", "vesselid", str(tmp_path / "cp")).awaitTermination()

    def fails(after):
        def one(*args):
            if after:
                apply(*args)
            raise RuntimeError("stopped")

        monkeypatch.setattr(feed, "apply_batch", one)
        with pytest.raises(Exception, match="stopped"):
            run()
        monkeypatch.setattr(feed, "apply_batch", apply)

    history = lambda: sorted((r["vesselid"], r["callsign"], r["valid_from"], r["valid_to"]) for r in store.read("vessels").fillna("-").collect())
    records += [{"vesselid": "a", "callsign": "A", "modifiedon": "2024-01-01"}, {"vesselid": "b", "callsign": "B", "modifiedon": "2024-01-02"}]
    fails(after=False)
    assert not store.exists("vessels")
    run()
    assert history() == [("a", "A", "2024-01-01", "-"), ("b", "B", "2024-01-02", "-")]
    # one more of the mark's time, and a change
    records += [{"vesselid": "c", "callsign": "C", "modifiedon": "2024-01-02"}]
    records[0] = {"vesselid": "a", "callsign": "A2", "modifiedon": "2024-01-05"}
    fails(after=True)
    want = [("a", "A", "2024-01-01", "2024-01-05"), ("a", "A2", "2024-01-05", "-"), ("b", "B", "2024-01-02", "-"), ("c", "C", "2024-01-02", "-")]
    assert history() == want
    run()
    run()
    assert history() == want
    server.shutdown()


def test_sync_from_a_service(spark, service, tmp_path, monkeypatch, capsys):
    url, handler = service
    handler.records["vessels"] = [vessel(i, f"V{i}", 1 + i % 2, ["Away", "Moored"][i % 2], f"2024-01-0{i}", _pilot_value=f"p{i % 3}", **cargoes("1,2", "Grain;Steel")) for i in range(1, 8)]
    handler.records["pilots"] = [{"pilotid": f"p{i}", "badge": f"B{i}"} for i in range(9)]
    root, entities = str(tmp_path / "store"), tmp_path / "entities.json"
    entities.write_text(json.dumps({"entities": [{"name": "vessel"}, {"name": "pilot", "filtered": True}]}))
    source = workflow.ODataRecords(spark, url, lambda: "t", concurrency=2)
    assert workflow.run_sync(spark, root, source, str(entities), verify_reference=True)
    store = Store(spark, root)
    assert store.read("vessels").count() == 7 and sorted(r[0] for r in store.read("pilots").select("pilotid").collect()) == ["p0", "p1", "p2"]
    assert handler.most_open <= 2
    # the second sync asks for what changed only
    handler.asked.clear()
    handler.records["vessels"][0] = vessel(1, "V1 again", 3, "Waiting", "2024-02-01", _pilot_value="p7", **cargoes("2", "Steel"))
    assert workflow.run_sync(spark, root, source, str(entities))
    columns = "vesselid,callsign,remarks,berthstate,hull,cargoes,modifiedon,_pilot_value,tonnage,dockid"
    assert ("vessels", {"$select": columns, "$orderby": "vesselid", "$filter": "modifiedon gt 2024-01-07"}) in handler.asked
    assert {t["$select"] for e, t in handler.asked if e == "pilots"} == {"pilotid,badge"}
    rows = store.read("vessels")
    assert rows.count() == 8 and rows.where("vesselid = 'a1' and valid_to = '2024-02-01'").count() == 1
    assert sorted(r["row_id"] for r in rows.collect()) == list(range(1, 9)) and store.read("pilots").count() == 4
    links = store.read("_junction_vessels_cargoes").where("entity_id = 'a1'").collect()
    assert sorted((r["option_code"], r["valid_from"], r["valid_to"]) for r in links if r["valid_to"]) == [(1, "2024-01-01", "2024-02-01"), (2, "2024-01-01", "2024-02-01")]
    assert [(r["option_code"], r["valid_from"]) for r in links if not r["valid_to"]] == [(2, "2024-02-01")]
    # the command line, with a reference that does not hold
    handler.records["vessels"][1] = vessel(2, "V2", 1, "Moored", "2024-03-01", _pilot_value="p99", **cargoes("1,2", "Grain;Steel"))
    monkeypatch.setattr(odata.Authenticator, "get_token", lambda self: "t")
    for name, value in (("API_URL", url), ("CLIENT_ID", "i"), ("CLIENT_SECRET", "s"), ("SCOPE", "q")):
        monkeypatch.setenv(f"DATAVERSE_{name}", value)
    monkeypatch.setattr(cli, "_source", lambda spark, env: workflow.ODataRecords(spark, url, lambda: "t"))
    assert cli.main(["sync", "--store", root, "--entities", str(entities), "--verify"], spark) == 1
    assert "vessels._pilot_value -> pilots: 1 of 9 rows; for example p99" in capsys.readouterr().out


def test_junctions_follow_batches_as_they_follow_history(spark, tmp_path):
    """One batch after the other, the junction is what all versions at once give."""
    from tidemark.operators import optionsets

    store = Store(spark, str(tmp_path / "store"))
    days = [
        [vessel(1, "A", 1, "Moored", "2024-01-01", **cargoes("1,2", "Grain;Steel")), vessel(2, "B", 1, "Moored", "2024-01-01", **cargoes("4", "Coal"))],
        [vessel(1, "A", 1, "Moored", "2024-01-02", **cargoes("2", "Steel")), vessel(3, "C", 1, "Moored", "2024-01-02")],
        [vessel(1, "A", 1, "Moored", "2024-01-03"), vessel(2, "B", 1, "Moored", "2024-01-03", **cargoes("4,1", "Coal;Grain"))],
        [vessel(1, "A", 1, "Moored", "2024-01-04"), vessel(1, "A2", 1, "Moored", "2024-01-05", **cargoes("3", "Fruit")), vessel(1, "A3", 1, "Moored", "2024-01-06", **cargoes("3,1", "Fruit;Grain"))],
        [],
    ]
    source = workflow.RawSource(DOCUMENT, {})
    for n, day in enumerate(days):
        source.records["vessels"] = raw(spark, *day) if day else spark.createDataFrame([], "seq long, raw string")
        assert workflow.run_workflow(store, source, [VESSELS], clock=f"2024-02-0{n + 1}")["success"]
    rows = store.read("vessels")
    history = rows.select(F.col("vesselid").alias("id"), "valid_from", F.col("row_id").alias("seq"), F.col("json_response").alias("raw"))
    picks = optionsets.detect(history.select("id", "seq", "raw"), ids=["id", "seq"])
    want = optionsets.junction(history.select("id", "seq", "valid_from"), picks, "id", "cargoes")
    told = lambda df: sorted((r["entity_id"], r["option_code"], r["valid_from"], r["valid_to"] or "") for r in df.collect())
    assert told(store.read("_junction_vessels_cargoes")) == told(want) and want.count() > 6
    assert sorted(r["row_id"] for r in rows.collect()) == list(range(1, rows.count() + 1))


def test_store_refuses_a_stale_writer_and_joins_small_folders(spark, tmp_path):
    store = Store(spark, str(tmp_path / "store"))
    number = lambda n: spark.createDataFrame([(n,)], "n int").coalesce(1)
    store.write("t", number(0))
    base = store.number("t")
    store.commit("t", append={"all": number(1)}, base=base)
    with pytest.raises(Conflict):
        store.commit("t", append={"all": number(2)}, base=base)
    for n in range(2, 6):
        store.commit("t", append={"all": number(n), "_own": number(100)}, note=f"n{n}")
    assert not store.compact("t", "all", most=10) and store.compact("t", "all", most=3)
    assert sorted(r[0] for r in store.read("t").collect()) == [0, 1, 2, 3, 4, 5] and store.note("t") == "n5"
    assert store.read("t", "_own").count() == 4 and len([1 for k, _ in store._lines("t") if k == "all"]) == 1
    assert store.vacuum("t") == 0 and store.vacuum("t", older=-1) >= 1
    assert sorted(r[0] for r in store.read("t").collect()) == [0, 1, 2, 3, 4, 5]
