"""The registered queries: those with SQL against it, the pipeline stage by stage."""

import corpus_pipeline
import duckdb
import pytest
from gleanery.llm import quality, queries
from pyspark.sql import functions as F
from test_llm_operators import brute_contaminated, brute_lines, by_hand, groups_of, hashed, similar_links
from tokenizers import Tokenizer

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", list(queries.SQL))
def test_sql(spark, name):
    con = duckdb.connect()
    for t in "documents pages benchmark labels conversations".split():
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    got, want = queries.QUERIES[name](spark, SF).toPandas(), con.sql(queries.SQL[name]).df()
    rows = lambda d: sorted(map(str, d[sorted(d.columns)].itertuples(index=False, name=None)))
    assert sorted(got.columns) == sorted(want.columns) and rows(got) == rows(want)


def test_pipeline(spark):
    """Each stage on all that the one before has kept, against brute force from the texts on, and the whole run against the stages."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    ids = lambda d: {r.doc_id for r in d.select("doc_id").collect()}
    seen = []
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = corpus_pipeline.materialize(stage(spark, docs, SF), name)
        assert out.schema == docs.schema and ids(out) <= ids(docs)
        seen.append((name, docs, out))
        docs = out
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    model = quality.learn(quality.feature_table(seen[0][1]), labels)
    assert ids(seen[0][2]) == {r.doc_id for r in seen[0][1].collect() if by_hand(model, r.text or "") >= 0.3} != ids(seen[0][1])
    known = {r.doc_id: r.quality for r in labels.collect()}
    assert all(known[i] == 0 for i in ids(seen[0][1]) - ids(seen[0][2]) if i in known)
    before, after = seen[1][1:]
    cut = {i: t for (i, _), (t, *_) in brute_lines(hashed(before), 1).items()}
    assert {r.doc_id: r.text for r in after.collect()} == {i: t for i, t in cut.items() if t.strip(" \t\n\x0b\x0c\r")}
    assert all(r.n_chars == len(r.text) for r in after.collect())
    left = sorted((r.doc_id, r.text or "") for r in seen[2][1].collect())
    group = groups_of(similar_links([t for _, t in left]), len(left))
    assert ids(seen[2][2]) == {left[g][0] for g in group}
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    bad = {i for i, _ in brute_contaminated([(r.doc_id, r.text) for r in seen[3][1].collect()], items)}
    assert ids(seen[3][2]) == ids(seen[3][1]) - bad
    last = {r.doc_id: r.text for r in docs.collect()}
    packed = corpus_pipeline.run(spark, SF).collect()
    tokens, fill = Tokenizer.from_file(queries.tokenizer_path()), {}
    want = {(i, len(tokens.encode(t, add_special_tokens=False).ids) + 1) for i, t in last.items()}
    assert {(i, sum(r.length for r in packed if r.doc_id == i)) for i in last} == want and {r.doc_id for r in packed} == set(last)
    for r in packed:
        fill.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in fill.values():
        ends = [0, *(o + n for o, n in sorted(parts))]
        assert [o for o, _ in sorted(parts)] == ends[:-1] and ends[-1] <= 1024
    assert len(fill) <= 1.01 * sum(n for _, n in want) / 1024 + 1


def test_stages_with_odd_rows(spark):
    """Null ids and texts, empty and repeated rows, one id for two texts, and columns with names that operators use."""
    words = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau upsilon".split()
    text = " ".join(words) + ". " + " ".join(reversed(words)) + "."
    rows = [(1, text), (1, text), (2, None), (3, ""), (None, text), (None, None), (4, text.replace("mu", "ny") + "\nmore of it"), (4, "another one"), (5, " \n\t")]
    extra = {"fp": "x", "k": 1, "n": 2, "row": "r", "key": "k", "line": "l", "h": 3, "grp": 4, "score": 0.5, "item_id": 6, "length": 7, "sequence_id": 8, "m_id": 9}
    d = spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long").withColumns({c: F.lit(v) for c, v in extra.items()})
    for name, stage in corpus_pipeline.STAGES:
        for docs in (d, d.limit(0), d.where("text is null")):
            out = stage(spark, docs, SF)
            if name != "packing":
                assert out.columns == d.columns and [f.dataType for f in out.schema] == [f.dataType for f in d.schema]
                assert all(tuple(r[c] for c in extra) == tuple(extra.values()) for r in out.collect())
            assert out.count() <= docs.count() and (out.count() > 0 or name != "packing" or docs.isEmpty())
    kept = lambda name: sorted(((str(r.doc_id), r.text) for r in dict(corpus_pipeline.STAGES)[name](spark, d, SF).collect()), key=str)
    assert kept("near_duplicates") == [("1", text), ("2", None), ("4", text.replace("mu", "ny") + "\nmore of it"), ("4", "another one")]
    assert kept("lines") == sorted(((str(i), t) for i, t in rows if (i, t) != (None, text)), key=str)
