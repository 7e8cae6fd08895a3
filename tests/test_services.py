import http.server
import json
import threading
import time
import urllib.error
import urllib.request
from collections import Counter

import pytest

from spanlake.operators import mapping
from spanlake.operators import services as S
from spanlake.plans import lookups as L
from spanlake.plans import stages

QUICK = S.Policy(batch=4, wait=0.0, longest=0.0, timeout=None)


def terms(spark, names, parts=1):
    return spark.createDataFrame([(n, f"about {n}") for n in names], "term string, context string").repartition(parts)


def reply(part):
    return {t: [{"ontology_id": f"X:{t}", "ontology_label": t, "ontology": "X", "more": 1}] for t, _ in part}


def rows(df):
    return {r.term: (None if r["items"] is None else [x.ontology_id for x in r["items"]], r.failure) for r in df.collect()}


def test_every_term_comes_back_once(spark):
    got = S.ask(terms(spark, [f"t{i}" for i in range(50)], 3), reply, QUICK)
    assert got.count() == 50
    assert rows(got) == {f"t{i}": ([f"X:t{i}"], None) for i in range(50)}
    assert S.ask(terms(spark, ["a"]).limit(0), reply, QUICK).collect() == []
    assert rows(S.ask(spark.createDataFrame([(None,), ("a",)], "term string"), reply, QUICK)) == {None: (None, "null term"), "a": (["X:a"], None)}


def test_busy_services_are_asked_again_and_lasting_faults_are_named():
    tries = Counter()

    def call(part):
        tries[part[0][0]] += 1
        if part[0][0] == "gone":
            raise S.HttpError(503, "down")
        if tries[part[0][0]] < 3:
            raise (S.HttpError(429), ConnectionResetError("reset"), S.Retryable("later"))[len(part[0][0]) % 3]
        return reply(part)

    for name in ("a", "ab", "abc"):
        assert [x[0] for x in S.answers([(name, None)], call, QUICK)] == [name] and tries[name] == 3
    assert S.answers([("gone", None), ("with it", None)], call, QUICK) == [(t, None, "HttpError: HTTP 503: down", 4) for t in ("gone", "with it")]
    assert tries["gone"] == 4  # what may pass is not cut smaller


def test_one_bad_term_costs_a_few_calls_and_no_other_term():
    calls = []

    def call(part):
        calls.append(len(part))
        if any(t == "bad" for t, _ in part):
            raise S.HttpError(400, "refused")
        return reply(part)

    part = [(f"t{i}", None) for i in range(63)] + [("bad", None)]
    got = {t: f for t, _, f, _ in S.answers(part, call, S.Policy(wait=0.0, timeout=None))}
    assert {t for t, f in got.items() if f} == {"bad"} and len(got) == 64 and len(calls) == 13
    assert sum(f is not None for _, _, f, _ in S.answers(part, call, S.Policy(wait=0.0, timeout=None, cut=False))) == 64
    assert S.answers([("a", None)], lambda part: ["no dict"], QUICK) == [("a", None, "TypeError: a reply of type list", 1)]
    assert S.answers([("a", None), ("b", None)], lambda part: {"a": None, "b": "?"}, QUICK) == [("a", [], None, 1), ("b", [], None, 1)]


def test_timeouts(spark):
    def call(part):
        if part[0][0] == "slow":
            time.sleep(30)
        return reply(part)

    began = time.time()
    policy = S.Policy(batch=1, wait=0.0, longest=0.0, attempts=2, timeout=0.3)
    got = rows(S.ask(terms(spark, ["slow", "fast", "fast too"]), call, policy))
    assert got == {"slow": (None, "TimeoutError: no reply in 0.3 s"), "fast": (["X:fast"], None), "fast too": (["X:fast too"], None)}
    assert time.time() - began < 20


def test_batches_are_concurrent_and_bounded():
    lock, now, most, sizes = threading.Lock(), [0], [0], []

    def call(part):
        with lock:
            now[0] += 1
            most[0] = max(most[0], now[0])
            sizes.append(len(part))
        time.sleep(0.02)
        with lock:
            now[0] -= 1
        return reply(part)

    class Here:
        """Runs the tasks' function in this process."""

        columns = ["term", "context"]

        def select(self, *_):
            return self

        def mapInArrow(self, run, schema):  # noqa: N802
            import pyarrow as pa

            return list(run(pa.RecordBatch.from_pydict({"term": [f"{b}-{i}" for i in range(7)], "context": ["c"] * 7}) for b in range(20)))

    got = S.ask(Here(), call, S.Policy(batch=10, workers=3, wait=0.0, timeout=None))
    assert sum(b.num_rows for b in got) == 140 and sizes == [10] * 14 and most[0] == 3


def test_pauses_double_up_to_a_limit_and_heed_the_service():
    p = S.Policy()
    assert [2 <= p.pause(0, OSError()) <= 2.5, 4 <= p.pause(1, OSError()) <= 5, 8 <= p.pause(2, OSError()) <= 10, 8 <= p.pause(9, OSError()) <= 10] == [True] * 4
    assert p.pause(0, S.HttpError(429, after=20)) == 20 and p.pause(0, S.HttpError(429, after=0)) >= 2
    assert [S.may_pass(e) for e in (S.HttpError(429), S.HttpError(500), S.HttpError(404), TimeoutError(), ConnectionError(), ValueError())] == [True, True, False, True, True, False]


class _Service(http.server.BaseHTTPRequestHandler):
    """Over HTTP: busy for the first request of each batch, refuses the term `bad`."""

    met: set = set()

    def do_POST(self):  # noqa: N802
        names = json.loads(self.rfile.read(int(self.headers["Content-Length"])))
        first = (names[0], len(names))
        status = 429 if first not in self.met else 400 if "bad" in names else 200
        self.met.add(first)
        self.send_response(status)
        self.end_headers()
        self.wfile.write(json.dumps({n: [{"ontology_id": f"H:{n}", "ontology_label": n, "ontology": "H"}] for n in names}).encode())

    def log_message(self, *_):
        return


def test_against_a_real_http_service(spark):
    server = http.server.ThreadingHTTPServer(("127.0.0.1", 0), _Service)
    threading.Thread(target=server.serve_forever, daemon=True).start()
    url = f"http://127.0.0.1:{server.server_port}/"

    def call(part):
        request = urllib.request.Request(url, json.dumps([t for t, _ in part]).encode())
        try:
            with urllib.request.urlopen(request, timeout=10) as r:
                return json.loads(r.read())
        except urllib.error.HTTPError as e:
            raise S.HttpError(e.code) from None

    try:
        got = rows(S.ask(terms(spark, [f"t{i}" for i in range(30)] + ["bad"], 3), call, S.Policy(batch=8, wait=0.0, longest=0.0, timeout=20)))
    finally:
        server.shutdown()
    assert got == {f"t{i}": ([f"H:t{i}"], None) for i in range(30)} | {"bad": (None, "HttpError: HTTP 400")}


# ---- what stays between runs ----


class Counting:
    """A service that leaves a file for each term it is asked for, refuses some, and says which run asked."""

    def __init__(self, folder, run, refused=()):
        self.folder, self.run, self.refused = str(folder), run, set(refused)

    def __call__(self, part):
        import pathlib
        import uuid

        if self.refused & {t for t, _ in part}:
            raise S.HttpError(400)
        for t, c in part:
            pathlib.Path(self.folder, f"{self.run}.{t}.{uuid.uuid4().hex}").write_text(c or "")
        return {t: [{"ontology_id": f"{self.run}:{t}", "ontology_label": t, "ontology": None}] for t, _ in part}


def fresh(spark, name):
    import uuid

    return f"{stages.shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def test_a_second_run_asks_for_new_and_failed_terms_only(spark, tmp_path):
    store = L.LookupStore(spark, fresh(spark, "store"))
    one = store.run(terms(spark, ["a", "b", "c", "d"], 2), Counting(tmp_path, "one", ["c"]), QUICK)
    assert rows(one.selectExpr("*", "string(null) AS failure")) == {t: ([f"one:{t}"], None) for t in "abd"}
    assert [tuple(r) for r in store.failed.read().collect()] == [("c", "HttpError: HTTP 400", 2, 1)] or store.failed.read().first().runs == 1
    two = store.run(terms(spark, ["a", "c", "e", "e", "f"], 2), Counting(tmp_path, "two", ["f"]), QUICK)
    assert sorted((r.term, r["items"][0].ontology_id) for r in two.collect()) == [("a", "one:a"), ("c", "two:c"), ("e", "two:e")]
    asked = Counter(p.name.rsplit(".", 1)[0] for p in tmp_path.iterdir())
    assert asked == Counter(["one.a", "one.b", "one.d", "two.c", "two.e"])
    assert {r.term: r.runs for r in store.failed.read().collect()} == {"f": 1}
    assert {p.read_text() for p in tmp_path.iterdir()} == {f"about {t}" for t in "abdce"}
    store.run(terms(spark, ["f"]), Counting(tmp_path, "three", ["f"]), QUICK)
    store.run(terms(spark, ["a"]), Counting(tmp_path, "four"), QUICK)
    assert {r.term: r.runs for r in store.failed.read().collect()} == {"f": 2}  # not asked for, not forgotten
    mapped = {r.term: (r.ontology_id, r.error) for r in store.lookup(terms(spark, ["a", "f", "none"]), lambda part: (_ for _ in ()).throw(S.HttpError(404)), "svc", QUICK).collect()}
    assert mapped == {"a": ("one:a", None), "f": (None, "HttpError: HTTP 404"), "none": (None, "HttpError: HTTP 404")}


def test_answers_without_candidates_are_answers(spark, tmp_path):
    store = L.LookupStore(spark, fresh(spark, "store"))
    calls = []
    store.run(terms(spark, ["a", "b"]), lambda part: {}, QUICK)
    got = store.run(terms(spark, ["a", "b"]), lambda part: calls.append(part) or {}, QUICK)
    assert got.count() == 2 and store.failed.read().count() == 0 and not calls
    assert [(r.error, r.ontology_id) for r in mapping.lookup(terms(spark, ["a"]), got, "x").collect()] == [("No mapping found", None)]


def test_first_in_first_out(spark):
    cache = L.TermCache(spark, fresh(spark, "cache"), most=5)
    batch = lambda names: spark.createDataFrame([(n, []) for n in names], f"term string, items array<{S.ITEM}>")
    held = lambda: sorted((r.added, r.term) for r in cache.read().collect())
    want: list[tuple[int, str]] = []
    for run, names in enumerate(("ab", "bcd", "a", "xyz", "hgfedcbaz", "q"), 1):
        cache.merge(batch(names))
        want += [(run, n) for n in sorted(set(names) - {t for _, t in want})]
        want = want[max(0, len(want) - 5) :]
        assert held() == want
    assert len(cache.table.versions()) == 2  # older ones are gone
    with pytest.raises(ValueError):
        L.TermCache(spark, "x", 0)


def test_a_version_counts_when_it_is_complete(spark):
    table = L.Snapshots(spark, fresh(spark, "t"), "x int")
    assert table.versions() == [] and table.read().collect() == []
    one = spark.createDataFrame([(1,)], "x int")
    assert table.write(one) == 1
    one.write.option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false").parquet(table.place(2))  # as a run leaves it that dies before its commit
    assert table.versions() == [1] and [r.x for r in table.read().collect()] == [1]
    assert table.write(spark.createDataFrame([(3,)], "x int")) == 3
    assert table.versions() == [1, 3] and [r.x for r in table.read().collect()] == [3] and [r.x for r in table.read(1).collect()] == [1]
    with pytest.raises(Exception, match="exists"):
        one.write.mode("errorifexists").parquet(table.place(3))
