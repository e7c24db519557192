"""Operators on small inline frames."""

import json
import re

from gleanery.functions import text as T
from gleanery.operators import checks, dedup, planning, refine, release, retrieval, review, selection, state, validate, vocabulary
from gleanery.plans.progress import Progress
from gleanery.plans.stages import Plan
from gleanery.sources import jsonl, models, tools
from pyspark.sql import functions as F


def one(spark, expr, **values):
    return spark.range(1).select(*[F.lit(v).alias(k) for k, v in values.items()]).select(expr).first()[0]


def test_text_functions(spark):
    v = lambda f, s: one(spark, f(F.col("s")), s=s)
    assert v(T.normalize_url, "https://a.b/c/?q=1#x") == "https://a.b/c/?q=1/" and v(T.normalize_url, "https://a.b/c//") == "https://a.b/c//"
    assert v(T.strip_tags, "<b>a</b>&amp;b") == "a b"
    assert [tuple(x) for x in v(T.markdown_links, "[a](u) and [b](w)")] == [("a", "u"), ("b", "w")]
    assert v(T.links, "see https://x.org/a. `https://y.org` http://localhost:1 https://a.example.com/") == ["https://x.org/a"]
    assert v(T.unclosed_fence, "```a") and not v(T.unclosed_fence, "```a```")
    assert [tuple(x) for x in v(T.fenced_blocks, "```ts\nx\n``` ```\ny\n```")] == [("ts", "x\n"), ("", "y\n")]
    assert json.loads(v(T.loose_json, 'Sure:\n```json\n[{"a": 1}]\n```')) == [{"a": 1}] and json.loads(v(T.loose_json, 'it is {"a": 1} ok')) == {"a": 1}
    assert v(T.loose_json, "none {here") is None
    assert v(lambda c: T.split_sections(c, "ANSWER"), "well\n=====ANSWER 2=====\nb\n=====ANSWER 1=====\n\na\nand =====ANSWER 3===== too\n=====ANSWER 2=====\nc ") == {1: "a\nand =====ANSWER 3===== too", 2: "c"}
    assert v(T.shingles, "a b") == [] and v(T.shingles, "A b, c d") == ["a b c", "b c d"]
    assert one(spark, T.js_round(F.lit(-2.5))) == -2 and one(spark, T.js_round(F.lit(2.5))) == 3
    assert v(T.to_number, "x") == 0.0 and v(T.to_number, "4.5") == 4.5
    assert tuple(v(T.decision, "3 d too vague")) == (3, "d", "too vague") and v(T.decision, "what")["k"] is None
    assert v(T.strip_ansi, "\x1b[31mx\x1b[0m") == "x"
    assert one(spark, T.rotate(F.array(*map(F.lit, "abc")), F.lit(4))) == ["b", "c", "a"]
    assert [tuple(x) for x in v(T.diagnostics, "a.ts(3,5): error TS2305: no member\nok")] == [("a.ts", 3, 2305, "no member")]
    assert v(T.imported_names, "{ a as b, type C, /* x */ d }") == ["a", "C", "d"]


def test_state(spark):
    log = spark.createDataFrame([(1, 1, "a"), (1, 3, "c"), (2, 2, "b"), (1, 2, None)], "id int, seq int, v string")
    assert sorted(map(tuple, state.latest_by(log, "id", "seq").collect())) == [(1, 3, "c", 1), (2, 2, "b", 2)]
    assert sorted(r.v for r in state.first_by(log, "id", "seq").collect()) == ["a", "b"]
    assert state.latest_by(log.limit(0), "id", "seq").count() == 0
    q = spark.createDataFrame([("a", "old"), ("b", "old"), ("c", "x")], "id string, question string")
    rv = spark.createDataFrame([("a", 1, True, "new wording"), ("a", 2, True, None), ("b", 1, True, None), ("b", 2, False, None)], "id string, seq int, keep boolean, question string")
    assert [tuple(r) for r in state.kept_questions(q, rv).collect()] == [("a", "new wording")]


def test_planning(spark):
    docs = spark.range(25).select("id")
    assert [r.n for r in planning.numbered(docs, [F.col("id")]).orderBy("id").collect()] == list(range(25))
    for n in (1, 7, 24, 25, 40):
        assert sorted(r.id for r in planning.systematic_sample(docs, n, [F.col("id")]).collect()) == sorted({i * 25 // n for i in range(n)} if n < 25 else range(25))
    assert one(spark, planning.classify(F.lit("guides/deploy/x"))["area"]) == "deploy" and one(spark, planning.classify(F.lit("zzz"))["area"]) == "basics"
    j = planning.jobs(spark.createDataFrame([(14, 7), (5, 5)], "quota long, done long")).orderBy("batch").collect()
    assert [(r.batch, r.n) for r in j] == [(2, 6), (3, 1)]


def test_checks(spark):
    rows = [("a", "how-to", "x", "INSUFFICIENT"), ("b", "migration", "x", "The old thing was removed: gone() " + "y" * 60), ("c", "how-to", "x", "Use gone() " + "y" * 60 + " https://bad.org/p https://ok.org/p"), ("d", "how-to", "x", "z" * 2601)]
    df = spark.createDataFrame(rows, "id string, type string, area string, answer string")
    known = spark.createDataFrame([("https://ok.org/p/",)], "url string")
    out = {r.id: r for r in checks.check_answers(df, [("gone", r"gone\s*\(")], known).collect()}
    assert out["a"].hard[:2] == ["insufficient", "too-short"] and out["a"].hard[2].startswith("artifact:")
    assert out["b"].hard == [] and out["b"].soft == ["stale-in-migration:gone"]
    assert out["c"].hard == ["bad-link:https://bad.org/p", "stale:gone"] and out["c"].soft == ["multiple-links"] and out["c"].links == 2
    assert out["d"].soft == ["long"]


def test_greedy_is_sequential(spark):
    import random

    rnd = random.Random(1)
    pairs = {tuple(sorted(rnd.sample(range(60), 2))) for _ in range(120)}
    kept: list[int] = []
    for i in range(60):
        if not any((min(i, k), max(i, k)) in pairs for k in kept):
            kept.append(i)
    nodes = spark.range(60).select("id", F.col("id").alias("rank"))
    assert sorted(r.id for r in dedup.greedy(nodes, spark.createDataFrame(list(pairs), "a long, b long")).collect()) == kept


def test_cosine_pairs(spark):
    import random

    rnd = random.Random(2)
    vs = [[rnd.gauss(0, 1) for _ in range(5)] for _ in range(80)] + [[0.0] * 5]
    norm = lambda v: sum(x * x for x in v) ** 0.5
    want = {(i, j) for i in range(80) for j in range(i + 1, 80) if sum(a * b for a, b in zip(vs[i], vs[j])) / norm(vs[i]) / norm(vs[j]) > 0.8}
    got = dedup.cosine_pairs(spark.createDataFrame(list(enumerate(vs)), "id long, vector array<double>"), 0.8, pivots=6).collect()
    assert {(r.a, r.b) for r in got} == want and len(got) == len(want)


def test_capped(spark):
    rows = [(i, i, "spec:" + "ab"[i % 2] if i % 3 else "x", f"p{i % 5}", "easy" if i % 2 else "hard") for i in range(200)]
    got = selection.capped(spark.createDataFrame(rows, "id long, rank long, area string, page string, difficulty string"), 40, {"x": 0.11}, pool_cap=0.5, page_cap=6, difficulty={"easy": 0.2, "hard": 0.2})
    cnt: dict = {}
    want = {}
    for turn in (1, 2):
        for i, _, a, p, d in rows:
            a = "spec" if a.startswith("spec:") else a
            if len(want) < 40 and i not in want and cnt.get(a, 0) < (0.5 if a == "spec" else 0.11) * 40 and cnt.get(p, 0) < 6 and (turn == 2 or cnt.get(d, 0) < 0.2 * 40 * 1.1):
                for k in (a, p, d):
                    cnt[k] = cnt.get(k, 0) + 1
                want[i] = turn
    assert {r.id: r["pass"] for r in got.collect()} == want
    few = spark.createDataFrame([(i, i, f"spec:{i % 3}", f"p{i}", "expert") for i in range(30)], "id long, rank long, area string, page string, difficulty string")
    assert {r.id: r["pass"] for r in selection.capped(few, 20).collect()} == {0: 1, 1: 1}  # a tenth of 20 for all of them together
    assert selection.capped(few.limit(0), 20).count() == 0


def test_greedy_chain(spark):
    chain = spark.createDataFrame([(i, i + 1) for i in range(299)], "a long, b long")
    nodes = spark.range(300).select("id", F.col("id").alias("rank"))
    assert sorted(r.id for r in dedup.greedy(nodes, chain, rounds=3).collect()) == list(range(0, 300, 2))


def test_rule_hits(spark):
    texts = spark.createDataFrame([(1, "An OLD call"), (2, "none"), (3, None)], "id long, text string")
    rules = spark.createDataFrame([(f"r{i}", "old" if i % 2 else f"x{i}y", i) for i in range(450)], "rule_id string, re string, weight int")
    got = checks.rule_hits(texts, rules).collect()
    assert {(r.id, r.rule_id, r.weight) for r in got} == {(1, f"r{i}", i) for i in range(1, 450, 2)}
    assert checks.rule_hits(texts, rules.limit(0)).count() == 0


def test_contained(spark):
    import random

    rnd = random.Random(4)
    words = ["".join(rnd.choice("ab_1") for _ in range(rnd.randint(1, 4))) for _ in range(60)]
    texts = [rnd.choice(" .-").join(rnd.sample(words, 5)).upper() for _ in range(12)] + [None, ""]
    asked = sorted(set(words) | {"a b", "b.a", "zz", "1_", "_"})
    corpus, tokens = spark.createDataFrame([(t,) for t in texts], "content string"), spark.createDataFrame([(t,) for t in asked], "token string")
    low = [t.lower() for t in texts if t]
    assert {r.token for r in vocabulary.contained(tokens, corpus, block=7).collect()} == {w for w in asked if any(w in t for t in low)}
    edge = lambda w: re.compile(rf"\b{re.escape(w)}\b", re.ASCII)
    assert {r.token for r in vocabulary.contained(tokens, corpus, whole=True, block=7).collect()} == {w for w in asked if any(edge(w).search(t) for t in low)}


def test_first_fit_rows(spark):
    rows = [(g, i, (i * 37) % 23) for g in ("a", "b", None) for i in range(30)]
    got = retrieval.first_fit_rows(spark.createDataFrame(rows, "g string, i long, n long"), "g", "i", "n", 50).collect()
    want = set()
    for g in "ab":
        used = 0
        for i in range(30):
            if used + (i * 37) % 23 <= 50:
                used += (i * 37) % 23
                want.add((g, i))
    assert {(r.g, r.i) for r in got} == want and len(got) == len(want)


def test_upserts_and_compaction(spark, tmp_path):
    from gleanery.streaming import streams

    table, checkpoint, source = (str(tmp_path / n) for n in ("table", "checkpoint", "source"))

    def arrive(rows):
        spark.createDataFrame(rows, "k long, seq long, v string").coalesce(1).write.mode("append").parquet(source)
        streams.upsert_latest(streams.read_stream(spark, source, spark.read.parquet(source).schema), "k", "seq", table, checkpoint)

    view = lambda: {r.k: r.v for r in streams.latest_view(spark, table, "k", "seq").collect()}
    batches = lambda: sorted(r[0] for r in spark.read.parquet(table).select("batch").distinct().collect())
    arrive([(1, 1, "a"), (2, 2, "b"), (1, 3, "c")])
    arrive([(2, 5, "d"), (3, 4, "e")])
    arrive([(1, 2, "late")])
    assert view() == {1: "c", 2: "d", 3: "e"} and batches() == [0, 1, 2]
    streams.compact(spark, table, "k", "seq")
    assert view() == {1: "c", 2: "d", 3: "e"} and batches() == [2]
    arrive([(3, 9, "f")])
    assert view() == {1: "c", 2: "d", 3: "f"} and batches() == [2, 3]


def test_late_rows_are_dropped(spark, tmp_path):
    from datetime import datetime, timedelta

    from gleanery.streaming import streams

    table, checkpoint, source = (str(tmp_path / n) for n in ("table", "checkpoint", "source"))
    start = datetime(2024, 1, 1)

    def arrive(*hours):
        spark.createDataFrame([(start + timedelta(hours=h), "x") for h in hours], "ts timestamp, kind string").coalesce(1).write.mode("append").parquet(source)
        s = streams.read_stream(spark, source, spark.read.parquet(source).schema)
        streams.drain_to_table(streams.windowed_counts(s, "ts", ["kind"], "1 hour", late="2 hours"), table, checkpoint)

    arrive(0.2, 0.4, 5.5)
    arrive(0.3, 4.5, 9.0)  # the first is later than the watermark of 3.5, the second is not
    got = {(r.window_start - start).seconds // 3600: r.n for r in spark.read.parquet(table).collect()}
    assert got == {0: 2, 4: 1, 5: 1}


def test_scratch(spark, tmp_path, monkeypatch):
    from gleanery.plans import tables

    monkeypatch.setattr(tables, "shared_dir", lambda _: str(tmp_path))
    assert tables.materialize(spark.range(3), "x").count() == 3 and list(tmp_path.iterdir())
    tables.clear_scratch(spark)
    assert not list(tmp_path.iterdir())


def test_a_cluster_names_its_shared_folder():
    from types import SimpleNamespace

    import pytest
    from gleanery.plans import tables

    session = lambda master, where: SimpleNamespace(conf={"spark.checkpoint.dir": where}, sparkContext=SimpleNamespace(master=master))
    assert tables.shared_dir(session("yarn", "hdfs:///x")) == "hdfs:///x" and tables.shared_dir(session("local[2]", None)) == tables.FALLBACK_DIR
    for master in ("yarn", "local-cluster[2,1,1000]", "spark://h:1"):
        with pytest.raises(ValueError):
            tables.shared_dir(session(master, None))


def test_gate_cascade(spark):
    v = "verdict string, accuracy double, version double, usefulness double, concise double"
    q = spark.createDataFrame([(i, f"q{i}") for i in "abcdefg"], "id string, question string")
    a = spark.createDataFrame([(i, f"answer {i}", []) for i in "abcdef"], "id string, answer string, sources array<string>")
    checked = spark.createDataFrame([(i, [], ["long"]) for i in "abcdef"], "id string, hard array<string>, soft array<string>")
    j = spark.createDataFrame([("a", "pass", 5.0, 5.0, 4.0, 4.0, None), ("b", "pass", 5.0, 5.0, 3.0, 4.0, None), ("c", "reject", 5.0, 5.0, 5.0, 5.0, None), ("d", "fix", 5.0, 5.0, 5.0, 5.0, ""), ("e", "pass", 5.0, 5.0, 5.0, 5.0, None)], f"id string, {v}, fixed_answer string")
    r = spark.createDataFrame([("f", "retry", "t", [], (None, None, None, None, None))], f"id string, status string, answer string, soft array<string>, verdict struct<{v.replace(' string', ':string').replace(' double', ':double')}>")
    hard = spark.createDataFrame([], "id string, hard array<string>, soft array<string>")
    o = spark.createDataFrame([("e", "drop", None, None)], "id string, action string, answer string, question string")
    got = {x.id: (x.drop_reason, x.score) for x in selection.candidates(q, a, checked, j, r, hard, hard.select("id", "hard"), o).collect()}
    assert got == {"a": (None, 30.25), "b": ("low-scores", None), "c": ("judge-reject", None), "d": ("fix-failed-checks", None), "e": ("manual-drop", None), "f": ("refine-retry", None)}


def test_context_first_fit(spark):
    h = spark.createDataFrame([(1, 0, 1, "a", "x" * 50), (1, 0, 2, "b", "y" * 80), (1, 1, 1, "c", "z" * 40), (1, 1, 2, "d", "x" * 50)], "query_id int, prio int, rank int, key string, content string")
    r = retrieval.context(h, budget=100).first()
    assert r["keys"] == ["a", "c"]


def test_reviews_and_sections(spark):
    b = spark.createDataFrame([(0, 1, "a", "old question"), (0, 2, "b", "old question")], "batch int, pos int, id string, question string")
    reply = json.dumps([{"i": "1", "keep": True, "question": "a much better wording of it"}, {"i": "2", "reason": "vague"}])
    r = spark.createDataFrame([(0, 2, "m", "ok " + reply)], "batch int, size int, model string, reply string")
    assert [(x.id, x["keep"], x.question) for x in review.usable_reviews(b, r, ["batch"]).orderBy("id").collect()] == [("a", True, "a much better wording of it"), ("b", False, None)]
    s = spark.createDataFrame([(0, 2, "m", "=====ANSWER 2=====\nyes")], "batch int, size int, model string, reply string")
    assert [tuple(x) for x in review.section_answers(b, s, ["batch"]).collect()] == [("b", "yes", "m")]


def test_validate(spark):
    m = lambda q, a: [("user", q), ("assistant", a)]
    good = "An answer that is long enough to be taken as one."
    rows = [("1", m("What is a well formed question?", good)), ("2", m("what is a  well formed question?", good + " TODO")), ("3", m("short", "x")), ("3", [("user", "x")]), ("4", m("Where does the link of this lead to?", good + " https://a.org/x https://b.org/y ```"))]
    data = spark.createDataFrame(rows, "id string, messages array<struct<role:string,content:string>>")
    meta = spark.createDataFrame([(i, "how-to", "x", "1") for i in "123"], "id string, type string, topic string, version string")
    got = {(r.rule, r.id) for r in validate.failures(data, meta, 5, [], spark.createDataFrame([("https://a.org/x/",)], "url string"), "1").collect()}
    assert {("duplicate-question", "2"), ("artifact", "2"), ("short-question", "3"), ("short-answer", "3"), ("messages", "3"), ("duplicate-id", "3"), ("no-metadata", "4"), ("links", "4"), ("unknown-link", "4"), ("unclosed-fence", "4"), ("near-duplicate", "2")} <= got
    assert ("count", None) not in got and ("meta-count", None) in got


def test_explain(spark):
    got = one(spark, refine.explain(F.array(F.lit("bad-link:http://x"), F.lit("odd")), F.array(F.lit("ts1: x"))))
    assert "http://x" in got[0] and got[1] == "odd" and got[2].endswith("ts1: x")


def test_sources(spark, tmp_path):
    p = str(tmp_path / "t.jsonl")
    (tmp_path / "t.jsonl").write_text('{"a": 1}\nnot json\n')
    rows, bad = jsonl.read_jsonl_tolerant(spark, p, "a int")
    assert [r.a for r in rows.collect()] == [1] and [(r.line, r.text) for r in bad.collect()] == [(2, "not json")]
    assert jsonl.read_jsonl(spark, str(tmp_path / "none"), "a int").count() == 0
    jsonl.write_jsonl(rows, str(tmp_path / "o"))
    jsonl.append_jsonl(rows, str(tmp_path / "o"))
    assert jsonl.read_jsonl(spark, str(tmp_path / "o"), "a int").count() == 2


def test_models(spark):
    class Broken:
        name = "broken"

        def generate(self, prompts):
            raise OSError("down")

    clock = [0.0]
    f = models.Failover([Broken(), models.StubModel("ok", str.upper)], clock=lambda: clock[0], sleep=lambda s: None)
    assert f.ask("x") == ("ok", "X") and f.until["broken"] == 600.0 and f.ask("x", lambda s: False) is None
    df = spark.createDataFrame([("a",), ("b",)], "prompt string")
    assert {r.reply for r in models.generate(df, models.StubModel("s", str.upper)).collect()} == {"A", "B"}
    assert {r.error for r in models.generate(df, Broken()).collect()} == {"OSError: down"}
    assert models.python_syntax("x = (")[0]["code"] == 1


def test_plan():
    p, ran = Plan(), []
    for n, always in (("a", False), ("b", False), ("c", True)):
        p.stage(n, always)(lambda s, n=n: ran.append(n))
    assert p.run({}, "b") == ["b", "c"] == ran


def test_numbered_within_groups(spark):
    rows = [(i, None if i % 5 == 0 else "big" if i % 5 < 4 else "small") for i in range(400)]
    got = planning.numbered(spark.createDataFrame(rows, "id long, g string").repartition(7), [F.col("id").desc()], ["g"]).collect()
    by: dict = {}
    for r in sorted(got, key=lambda r: -r.id):
        assert r.n == by.get(r.g, 0)
        by[r.g] = r.n + 1
    assert sum(by.values()) == 400 and planning.numbered(spark.createDataFrame([], "id long, g string"), [F.col("id")], ["g"]).count() == 0


def test_decisions(spark, tmp_path):
    (tmp_path / "d.txt").write_text("1 d vague\nnonsense\n2 i a wording that is long enough\n1 k\n9 d none\n")
    dumped = spark.createDataFrame([(1, "a", "q1"), (2, "b", "q2"), (3, "c", "q3")], "k int, id string, question string")
    out = {r.id: (r["keep"], r.question) for r in review.apply_decisions(dumped, jsonl.read_decisions(spark, str(tmp_path / "d.txt"))).collect()}
    assert out == {"a": (True, None), "b": (True, "a wording that is long enough"), "c": (True, None)}


def test_tools(spark, tmp_path):
    folder, cache = str(tmp_path / "asked"), str(tmp_path / "cache")
    (tmp_path / "asked").mkdir()

    def transport(tool, arguments):
        import os
        import uuid

        open(os.path.join(folder, uuid.uuid4().hex), "w").close()
        if tool == "bad":
            return json.dumps({"error": {"message": "no such tool"}})
        return "event: x\ndata: " + json.dumps({"result": {"content": [{"text": arguments}, {}]}})

    calls = spark.createDataFrame([("t", '{"a":1}'), ("t", '{"a":1}'), ("bad", "{}")], "tool string, arguments string")
    asked = lambda: len(list((tmp_path / "asked").iterdir()))
    for _ in range(2):
        got = {r.tool: r for r in tools.call_tools(calls, transport, cache, tries=2, sleep=lambda s: None).collect()}
        assert len(got) == 2 and got["t"].text == '{"a":1}\n' and got["t"].error is None and got["bad"].error == "RuntimeError: no such tool" and got["bad"].text is None
    assert asked() == 1 + 2 + 2
    hits = spark.createDataFrame([(1, json.dumps({"search_results": [{"source_url": "https://a.b/c#d", "title": "t", "content": "x"}]})), (2, "no json"), (3, None)], "q int, text string")
    assert [tuple(r) for r in tools.search_hits(hits, ["q"]).collect()] == [(1, 0, "https://a.b/c/", "https://a.b/c#d", "t", "x")]
    listing = spark.createDataFrame([("- **[One](https://s.org/spec/net/one/)** — stable, net\n- **[Two](https://s.org/spec/net/two/)** — draft",)], "text string")
    docs = spark.createDataFrame([("one", "---\ntitle: 'First'\n---\nx"), ("two", "y")], "slug string, content string")
    assert sorted((r.slug, r.title, r.status) for r in tools.topic_rows(tools.topics(listing), docs).collect()) == [("one", "First", "stable"), ("two", "two", "draft")]
    assert tools.require_major("7.1.0", 7) == "7.1.0"


def test_model_adapters():
    import pytest

    assert models.CommandModel("cat", ["cat"]).generate(["a\n", "b"]) == ["a", "b"]
    seen, waits = [], []

    def post(url, body, timeout):
        seen.append(body)
        if len(seen) == 1:
            raise OSError("down")
        return {"choices": [{"message": {"content": "ok"}}]}

    assert models.ChatModel("m", "u", seed=3, json_reply=True, post=post, sleep=waits.append).generate(["p"]) == ["ok"]
    assert waits == [2.0] and seen[1]["seed"] == 3 and seen[1]["response_format"] == {"type": "json_object"}
    with pytest.raises(ValueError):
        models.ChatModel("m", "u", post=lambda *a: {"choices": [{"message": {"content": ""}}]}, sleep=waits.append).generate(["p"])


def test_release(spark, tmp_path):
    cols = "id string, question string, answer string, sources array<string>, area string, focus string, type string, difficulty string, source_key string, judge string, verdict string"
    rows = [("b", "q two", "a b c", ["u"], "spec:x", "f", "how-to", "expert", "k", "j1", "pass"), ("a", "q", "a", [], "spec:y", "f", "how-to", "expert", "k", "j2", "fix"), ("c", "q", "a", [], "Basics", "f", "concept", "expert", "k", None, "pass")]
    taken = spark.createDataFrame(rows, cols)
    hard = spark.createDataFrame([("a", []), ("b", ["x"])], "id string, hard array<string>")
    meta = {r.id: r.verified for r in release.meta_rows(taken, hard, hard.where("id = 'b'"), spark.createDataFrame([("c",)], "id string"), "1").collect()}
    assert [(meta[i].deterministic_checks, meta[i].code_check, meta[i].manual) for i in "abc"] == [(True, True, False), (False, False, False), (False, True, True)]
    m = release.metadata(taken).first()
    assert (m.examples, m.words, m.tokens) == (3, 9, 13) and m.area == {"spec": 2, "Basics": 1} and m.judge == {"j1": 1, "j2": 1} and m.difficulty == {"expert": 3}
    assert [r.id for r in release.final_order(taken).collect()] == ["c", "b", "a"]
    release.write_release(taken, spark.createDataFrame([("a",)], "id string"), str(tmp_path))
    assert jsonl.read_jsonl(spark, str(tmp_path / "dataset"), "id string, messages array<struct<role:string,content:string>>").count() == 3
    e = release.metadata(taken.limit(0)).first()
    assert (e.examples, e.words) == (0, 0)
    assert spark.range(1).select(release.judge_for(F.lit("x"), ["x", "y"]), release.judge_for(F.lit("x"), ["x"])).first()[:] == ("y", None)
    d = release.dump(taken.withColumn("seq", F.ascii("id")), hard.where("id = 'a'"), 5)
    assert [r.value for r in release.dump_lines(d).collect()] == ["1|how-to|e|q two", "2|concept|e|q"]


def test_progress(spark):
    clock = iter([0.0, 120.0])
    p = Progress("x", 40, clock=lambda: next(clock))
    p.watch(spark.range(10), total=F.col("id")).write.format("noop").mode("overwrite").save()
    assert p.counts() == {"rows": 10, "total": 45} and p.line() == "[x] 10/40  eta 6m  2.0m elapsed"


def test_reviews_are_parsed_once_in_many_tasks(spark):
    """Replies grouped by their keys were parsed in one task, each many times: 190 ms for 10 KB."""
    b = planning.batches(spark.range(400).select(F.col("id").cast("string").alias("id"), F.lit("x").alias("g"), F.col("id").alias("seq"), F.lit("old").alias("question")), 40, [F.col("seq")], ["g"])
    items = F.collect_list(F.struct(F.col("pos").cast("string").alias("i"), (F.col("seq") % 2 == 0).alias("keep"), F.lit("r").alias("reason")))
    replies = b.where("not (batch = 3 and pos > 30)").groupBy("g", "batch").agg(F.concat(F.lit("So: "), F.to_json(items)).alias("reply"), F.lit(40).alias("size"), F.lit("m").alias("model"))
    out = review.usable_reviews(b, replies, ["g", "batch"])
    rows = {r.id: r.keep for r in out.collect()}
    assert rows == {str(i): i % 2 == 0 for i in range(400) if i // 40 != 3}
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("parse_json") <= 3 and "RepartitionByExpression" in plan


def test_jaccard_pairs_of_sets_with_one_id(spark):
    """An id with two sets had the prefixes of both counted as one, which let very frequent shingles in: pairs by the square."""
    rows = [(f"{i}", f"what is a{i} for b{i} there") for i in range(60)] + [(f"{i}", f"what is a{i} for b{i} there once more with other words than before") for i in range(60)]
    rows += [(f"x{i}", f"w{i} v{i} u{i} t{i} s{i} r{i} q{i} p{i} o{i} " + "n m l"[: i % 2 * 3]) for i in (1, 2)] + [("y2", "w2 v2 u2 t2 s2 r2 q2 p2 o2 other"), ("y1", "w1 v1 u1 t1 s1 r1 q1 p1")]
    data = spark.createDataFrame(rows, "id string, text string")
    sets = [(r.rep, set(r.own)) for r in dedup.shingle_sets(data, "id", "text").collect()]
    want = sorted((x, y, len(a & b) / len(a | b)) for x, a in sets for y, b in sets if x < y and len(a) >= 4 and len(b) >= 4 and len(a & b) / len(a | b) > 0.7)
    got = dedup.jaccard_pairs(dedup.shingle_sets(data, "id", "text"), 0.7)
    assert len(want) >= 1 and sorted(map(tuple, got.collect())) == want
    files = got.inputFiles()
    assert spark.read.parquet(*[f for f in files if "shingle-candidates" in f]).count() <= 10


def test_vectors_in_blocks(spark):
    """Every vector went to nearly every pivot's cell; now blocks are read where they lie and greedy passes list no pairs."""
    import random

    rnd = random.Random(5)
    vs = [[rnd.gauss(0, 1) for _ in range(4)] for _ in range(150)] + [[0.0] * 4]
    norm = lambda v: sum(x * x for x in v) ** 0.5
    near = lambda i, j: i < 150 and j < 150 and sum(a * b for a, b in zip(vs[i], vs[j])) / norm(vs[i]) / norm(vs[j]) > 0.8
    df = spark.createDataFrame([(i, v, 200 - i) for i, v in enumerate(vs)], "id long, vector array<double>, rank long")
    pairs = dedup.cosine_pairs(df, 0.8, part=16)
    assert sorted((r.a, r.b) for r in pairs.collect()) == [(i, j) for i in range(150) for j in range(i + 1, 150) if near(i, j)]
    assert not any("pivot-visits" in f for f in pairs.inputFiles())
    kept: list[int] = []
    for i in reversed(range(151)):
        if not any(near(i, k) for k in kept):
            kept.append(i)
    for head in (7, 20_000):
        assert sorted(r.id for r in dedup.greedy_vectors(df, 0.8, head=head).collect()) == sorted(kept)
    rest = [i for i in reversed(range(151)) if i % 2 and not any(near(i, k) for k in range(0, 151, 2))]
    want: list[int] = []
    for i in rest:
        if not any(near(i, k) for k in want):
            want.append(i)
    assert sorted(r.id for r in dedup.recheck(df.where("id % 2 = 1"), df.where("id % 2 = 0"), 0.8).collect()) == sorted(want)
    assert dedup.recheck(df.where("id % 2 = 1"), df.limit(0), 0.8).count() > 0 and dedup.greedy_vectors(df.limit(0), 0.8).count() == 0


def test_page_chunks_move_no_content(spark):
    """Each question met all chunks of its page in a join, each pair with the chunk's content."""
    chunks = spark.createDataFrame([("u", i, f"word{i % 7} Word{i % 5} text") for i in range(40)] + [("u", 40, None), ("v", 1, "none")], "url string, seq long, content string")
    q = spark.createDataFrame([(1, "word3 word4?", "u", "docs"), (2, "nothing alike", "u", "docs"), (3, "word1", "u", "spec"), (4, None, "v", "docs"), (5, "word1", None, "docs")], "id int, question string, source_key string, source_kind string")
    out = retrieval.page_chunks(q, chunks, 2)
    assert sorted((r.id, r.rank, r.content) for r in out.collect()) == [(1, 1, "word4 Word3 text"), (1, 2, "word3 Word4 text"), (2, 1, "word0 Word0 text"), (2, 2, "word1 Word1 text"), (4, 1, "none")]
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "Window" not in plan and "broadcast" in plan


def test_generate_bounds_its_batches(spark):
    """Prompts came 10,000 at a time, however long, with all their replies beside them."""
    spark.conf.unset("spark.sql.execution.arrow.maxBytesPerBatch")
    df = spark.range(700).coalesce(1).select("id", F.concat(F.lit("p"), F.col("id").cast("string")).alias("prompt"))
    out = models.generate(df, models.Failover([models.StubModel("a", lambda p: "r" + p), models.StubModel("b", lambda p: "r" + p)]))
    assert spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch") == str(4 << 20)
    assert sorted((r.id, r.reply, r.model) for r in out.collect()) == [(i, f"rp{i}", "ab"[i % 2]) for i in range(700)]
