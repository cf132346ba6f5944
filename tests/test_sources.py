import json
import os
import threading
import time
from http.server import BaseHTTPRequestHandler, HTTPServer, ThreadingHTTPServer

import pytest
from pyspark import InheritableThread
from pyspark.sql import functions as F

from almanac import runtime
from almanac.operators import mirror
from almanac.plans import samples
from almanac.sources import live, parse, wire
from almanac.streaming.refresh import Mirror

from .conftest import rows


def test_quarantine(spark):
    good, bad = wire.quarantine(samples.frame(spark, samples.ARTICLE))
    assert good.count() == 6 and rows(bad.select("id")) == [(7,)]


def test_retry():
    calls, pauses = [], []

    def f():
        calls.append(1)
        if len(calls) < 3:
            raise live.Transient("busy")
        return 200, "{}"

    assert live.with_retry(f, sleep=pauses.append) == (200, "{}")
    assert len(pauses) == 2 and 0.75 <= pauses[0] <= 1.25 and 1.5 <= pauses[1] <= 2.5

    def never():
        raise live.Transient("down")

    pauses.clear()
    with pytest.raises(live.Transient):
        live.with_retry(never, sleep=pauses.append)
    assert len(pauses) == 3


def test_urls():
    u = live.url_of("search", "EN", query="a b&c", limit=999)
    assert u.startswith("https://en.") and "srsearch=a+b%26c" in u and "srlimit=50" in u and "formatversion=2" in u
    assert "gscoord=47.6%7C-122.3" in live.url_of("nearby", "en", latitude=47.6, longitude=-122.3)
    assert live.url_of("summary", "fr", title="A B/é").endswith("/page/summary/A_B%2F%C3%A9")
    assert "section=3" in live.url_of("section", "en", title="x", section_index=3)


def test_coordinates_are_sent_in_full():
    u = live.url_of("nearby", "en", latitude=47.620512, longitude=-122.349312)
    assert "gscoord=47.620512%7C-122.349312&" in u
    assert [live.decimal(x) for x in (47.0, -0.00000012, 1e-9, 12.5)] == ["47", "-0.00000012", "0.000000001", "12.5"]


def test_user_agent(monkeypatch):
    assert live.user_agent() == live.USER_AGENT and live.user_agent("mine/1") == "mine/1"
    monkeypatch.setenv(live.USER_AGENT_ENV, "env/2")
    assert live.user_agent() == "env/2" and live.user_agent("mine/1") == "mine/1"


class _Slow(BaseHTTPRequestHandler):
    def do_GET(self):
        if "Slow" in self.path:
            time.sleep(30)
        self.send_response(200)
        self.end_headers()
        self.wfile.write(json.dumps({"path": self.path}).encode())

    def log_message(self, *a):
        pass


@pytest.fixture
def server():
    s = ThreadingHTTPServer(("127.0.0.1", 0), _Slow)
    s.daemon_threads = True
    threading.Thread(target=s.serve_forever, daemon=True).start()
    yield f"http://127.0.0.1:{s.server_port}"
    s.shutdown()


def _asked(spark, rows):
    return spark.createDataFrame(rows, "id long, operator string, language string, parameters map<string, string>")


def test_fetch_a_table_of_requests(spark, server):
    rows = [(i, "article", "en", {"title": f"T{i}"}) for i in range(20)]
    rows += [(20, "nearby", "fr", {"latitude": "47.620512", "longitude": "-122.349312", "radius_meters": "500"}), (21, "nearby", "en", {"latitude": "north", "longitude": "1"}), (22, "section", "en", {"title": "x", "section_index": "0"}), (23, "search", None, {"query": "a b", "limit": "7"}), (24, "summary", "en", None)]
    got = {r["id"]: r for r in live.fetch(_asked(spark, rows).repartition(3), base=server, retries=0).collect()}
    assert len(got) == 25 and all(got[i]["status"] == 200 and f"titles=T{i}&" in got[i]["url"] for i in range(20))
    assert "47.620512%7C-122.349312" in got[20]["url"] and "gsradius=500" in got[20]["url"]
    assert [got[i]["status"] for i in (21, 22, 24)] == [400] * 3 and got[21]["url"] is None
    assert "srlimit=7" in got[23]["url"] and json.loads(got[23]["body"])["path"].startswith("/w/api.php")


def test_cancelling_requests(spark, server):
    ended = []

    def run():
        with live.cancellable(spark, "slow-lookups"):
            try:
                live.fetch(_asked(spark, [(1, "article", "en", {"title": "Slow"})]), base=server, retries=0).collect()
            except Exception as e:  # noqa: BLE001
                ended.append(e)

    thread = InheritableThread(run, session=spark) if "session" in InheritableThread.__init__.__code__.co_varnames else InheritableThread(run)
    began = time.monotonic()
    thread.start()
    time.sleep(6)
    live.cancel(spark, "slow-lookups")
    thread.join(20)
    assert ended and "cancel" in str(ended[0]).lower() and time.monotonic() - began < 25


def test_live_source(spark):
    seen = []

    class Handler(BaseHTTPRequestHandler):
        def do_GET(self):
            seen.append((self.path, self.headers["User-Agent"], self.headers["Accept"]))
            body = json.dumps(samples.SUMMARY[0]) if "Python" in self.path else "<!DOCTYPE html><html></html>"
            self.send_response(200)
            self.end_headers()
            self.wfile.write(body.encode())

        def log_message(self, *a):
            pass

    server = HTTPServer(("127.0.0.1", 0), Handler)
    threading.Thread(target=server.serve_forever, daemon=True).start()
    live.register(spark)
    asked = [{"id": 1, "operator": "summary", "title": "Python"}, {"id": 2, "operator": "article", "title": "Busy page"}]
    df = spark.read.format("encyclopedia").options(requests=json.dumps(asked), baseUrl=f"http://127.0.0.1:{server.server_port}", userAgent="me/1", retries="1", pause="0.01").load()
    got = {r["id"]: r for r in df.collect()}
    server.shutdown()
    assert got[1]["status"] == 200 and json.loads(got[1]["body"])["pageid"] == 23862
    assert got[2]["status"] == 503 and sum("Busy" in p for p, _, _ in seen) == 2
    assert {(a, b) for _, a, b in seen} == {("me/1", "application/json")}


def test_mirror_query(spark):
    t = spark.createDataFrame([(i, f"n{i % 3}") for i in range(10)], "k int, n string")
    assert rows(mirror.query(t, [("k", "gt", 2), ("n", "in", ["n0", "n1"])], [("k", "desc")], 2, 1).select("k")) == [(6,), (7,)]
    with pytest.raises(ValueError):
        mirror.query(t, [("k", "like", 1)])
    got, more = mirror.capped(t, 4)
    assert got.count() == 4 and more and not mirror.capped(t, 10)[1]


def test_workspace(spark, tmp_path):
    w = mirror.Workspace(spark)
    w.register("t1", spark.createDataFrame([(1, "a"), (2, "b")], "k int, n string"))
    w.view("v1", "SELECT n, k * 2 AS k2 FROM t1")
    w.export("v1", str(tmp_path / "out"), "csv")
    w.load("t2", str(tmp_path / "out"), "n string, k2 int")
    assert rows(w.sql("SELECT t1.k, t2.k2 FROM t1 JOIN t2 ON t1.n = t2.n")) == [(1, 2), (2, 4)]
    w.drop()
    assert not spark.catalog.tableExists("v1")


def test_refresh_from_a_stream(spark, tmp_path):
    schema = "k int, v string"
    m = Mirror(spark, str(tmp_path / "m"), schema, ["k"], "at")
    assert not m.ready() and m.table().count() == 0
    changes = f"{schema}, at long, deleted boolean"

    def put(data):
        spark.createDataFrame(data, changes).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        m.follow(spark.readStream.schema(changes).parquet(str(tmp_path / "in")), str(tmp_path / "cp")).awaitTermination()

    put([(1, "a", 1, False), (2, "b", 1, False), (1, "c", 2, None)])
    assert m.ready() and rows(m.table()) == [(1, "c"), (2, "b")]
    put([(2, None, 3, True), (3, "d", 3, False)])
    assert rows(m.table()) == [(1, "c"), (3, "d")]
    m.apply(spark.createDataFrame([(9, "again", 9, False)], changes), 0)  # a batch that has been committed
    assert rows(m.table()) == [(1, "c"), (3, "d")]


def test_late_changes_neither_overwrite_nor_revive(spark, tmp_path):
    changes = "k int, v string, at long, deleted boolean"
    m = Mirror(spark, str(tmp_path / "m"), "k int, v string", ["k"], "at", buckets=4)
    m.apply(spark.createDataFrame([(1, "new", 10, False), (2, None, 10, True), (3, "x", 1, False)], changes), 0)
    m.apply(spark.createDataFrame([(1, "old", 5, False), (2, "old", 5, False), (3, "y", 2, False), (4, None, 3, True)], changes), 1)
    assert rows(m.table()) == [(1, "new"), (3, "y")]
    m.apply(spark.createDataFrame([(2, "back", 11, False), (1, "newer", 10, False)], changes), 2)
    assert rows(m.table()) == [(1, "newer"), (2, "back"), (3, "y")]
    m.apply(spark.createDataFrame([], changes), 3)
    assert m.version() == 3 and m.table().count() == 3
    # a batch rewrites the buckets it touches, and what newer versions replaced goes
    only = spark.createDataFrame([(3, "z", 9, False)], changes)
    for batch in (4, 5, 6):
        m.apply(only, batch)
    folders = {f"{v}/{b}" for v in os.listdir(tmp_path / "m") if v.startswith("v") for b in os.listdir(tmp_path / "m" / v) if b.startswith("_bucket")}
    bucket = only.select(F.pmod(F.xxhash64("k"), F.lit(4))).first()[0]
    assert {f for f in folders if f.startswith(("v4", "v5", "v6"))} == {f"v5/_bucket={bucket}", f"v6/_bucket={bucket}"}
    assert rows(m.table()) == [(1, "newer"), (2, "back"), (3, "z")]


def test_upsert_keeps_newer_rows(spark):
    current = spark.createDataFrame([(1, "a", 10), (2, "b", 1), (3, "c", 1)], "k int, v string, at long")
    changes = spark.createDataFrame([(1, "late", 5, False), (2, "new", 2, None), (3, None, 2, True), (4, "in", 1, False), (4, "first", 0, False), (None, "null key", 1, False)], "k int, v string, at long, deleted boolean")
    assert rows(mirror.upsert(current, changes, ["k"], "at")) == [(None, "null key", 1), (1, "a", 10), (2, "new", 2), (4, "in", 1)]
    assert rows(mirror.upsert(current.drop("at"), changes, ["k"], "at").where("k IS NOT NULL")) == [(1, "late"), (2, "new"), (4, "in")]


def test_search_and_places_tell_an_outage_from_no_hits(spark):
    bodies = samples.frame(spark, ['{"query": {"search": []}}', '{"query": {"geosearch": []}}', "<html>", '{"query": {"sea'])
    assert [r["status"] for r in wire.search_hits(bodies).orderBy("id").collect()] == ["no_hits", "no_hits", "unavailable", "unavailable"]
    assert [r["status"] for r in wire.geo_hits(bodies).orderBy("id").collect()] == ["no_hits", "no_hits", "unavailable", "unavailable"]
    good, bad = wire.quarantine(bodies)
    assert good.count() == bad.count() == 2


def test_a_cluster_needs_a_shared_folder():
    class Conf:
        def get(self, *a):
            return None

    class Session:
        def __init__(self, master):
            self.conf, self.sparkContext = Conf(), self
            self.master = master

        def getCheckpointDir(self):
            return None

    for master in ("local-cluster[2,1,1024]", "spark://host:7077", "yarn"):
        with pytest.raises(ValueError, match="spark.checkpoint.dir"):
            runtime.shared_dir(Session(master))


def test_parsing_text_columns(spark):
    one = lambda c, body: spark.createDataFrame([(body,)], "b string").select(c(F.col("b")).alias("r")).first()["r"]
    schema = "k int, v array<struct<a: int, b: string>>, w string"
    assert parse._fields(schema) == ["k int", "v array<struct<a: int, b: string>>", "w string"]
    assert one(lambda c: parse.json_object(c, schema), '{"k": 1, "v": [{"a": 2, "b": "x"}], "w": null}').asDict(True) == {"k": 1, "v": [{"a": 2, "b": "x"}], "w": None}
    assert one(lambda c: parse.csv(c, "k int, w string", ";"), '7;"a;b"').asDict() == {"k": 7, "w": "a;b"}
    assert one(lambda c: parse.xml(c, "_id int, name string, tag array<string>"), '<p id="3"><name>N</name><tag>a</tag><tag>b</tag></p>').asDict() == {"_id": 3, "name": "N", "tag": ["a", "b"]}
    for f, body in ((lambda c: parse.json_object(c, schema), '{"k": '), (lambda c: parse.csv(c, "k int"), "x"), (lambda c: parse.xml(c, "a int"), "<p><a>1</p>"), (lambda c: parse.csv(c, "k int"), None)):
        assert one(f, body) is None
    pytest.importorskip("yaml")
    df = spark.createDataFrame([(1, "k: 5\nw: text\nv:\n - a: 1\n   b: x\n"), (2, "k: [unclosed"), (3, "- a list"), (4, None)], "id int, body string")
    got = {r["id"]: r["r"] for r in parse.yaml(df, "body", schema, "r").collect()}
    assert got[1].asDict(True) == {"k": 5, "v": [{"a": 1, "b": "x"}], "w": "text"} and got[2] is got[3] is got[4] is None
