"""Each operator against brute force on small frames: nulls, empty and very long texts, ties, repeated rows, clashing columns, empty tables."""

import hashlib
import math
import random
import re
import zlib
from base64 import b32encode

import numpy as np
import public_tokenizers
import pytest
from gleanery.llm import chunks, decontaminate, exact_dedup, golay, line_dedup, near_copies, packing, preference, quality, queries, simhash, suffix, warc
from gleanery.llm.common import heavy_join
from gleanery.llm.components import components
from gleanery.plans import tables
from pyspark.sql import functions as F

SCHEMA = "doc_id long, text string, fp long, gid long, row string, lines string, first string"
VOCAB = [f"{a}{b}" for a in ("ka", "lo", "mi", "nu", "re", "sa", "to", "vi") for b in ("n", "r", "st", "l", "m", "na", "ko")]


def prose(rnd, n):
    return " ".join(rnd.choice(VOCAB) for _ in range(n))


@pytest.fixture(scope="module")
def texts():
    rnd = random.Random(5)
    shared = [prose(rnd, 60) for _ in range(3)]
    out = []
    for i in range(60):
        lines = [prose(rnd, rnd.randint(1, 25)) for _ in range(rnd.randint(1, 8))]
        if i % 4 == 0:
            lines.insert(rnd.randint(0, len(lines)), shared[i % 3] + "\n" + shared[(i + 1) % 3])
        out.append("\n".join(lines))
    out[7] = out[3].replace(" ", "  ")
    out[9] = out[3]
    out[11] = out[4].replace("ka", "Ka", 1)
    out[12] = "une été " + out[12] + " où ça 😀"
    out[20] = "ab" * 40_000
    out[21] = out[20][:-2] + "xy"
    return out


@pytest.fixture(scope="module")
def docs(spark, texts):
    rows = [(i * 3, t) for i, t in enumerate(texts)] + [(500, None), (501, ""), (502, " \n\t "), (None, texts[3]), (None, "quite alone"), (30, texts[10]), (30, texts[10]), (33, "the same id")]
    return spark.createDataFrame([(i, t, 1, 2, "r", "l", "f") for i, t in rows], SCHEMA).repartition(5)


@pytest.fixture(scope="module")
def none(docs):
    return docs.limit(0)


def pairs_of(docs):
    return [(r.doc_id, r.text or "") for r in docs.collect()]


BIG = 1 << 60


def test_components(spark):
    rnd = random.Random(1)
    edges = [(rnd.randint(-50, 400), rnd.randint(-50, 400)) for _ in range(220)] + [(i, i + 1) for i in range(1000, 1040)] + [(2000, i) for i in range(2001, 2100)] + [(7, 7)]
    parent: dict = {}

    def find(x):
        parent.setdefault(x, x)
        return x if parent[x] == x else find(parent[x])

    for a, b in edges:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    linked = {x for a, b in edges if a != b for x in (a, b)}
    assert got == {x: find(x) for x in linked}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


@pytest.mark.parametrize("how", ["inner", "left", "left_semi"])
def test_heavy_join_is_a_join(spark, how):
    rnd = random.Random(13)
    rows = spark.createDataFrame([(rnd.choice((1, 1, 1, 2, 3)) if rnd.random() < 0.7 else rnd.randint(4, 300), None if i % 9 == 0 else i % 2, i) for i in range(3000)], "k long, m int, v long").repartition(5)
    found = rows.where("m is not null and k % 3 <> 0").groupBy("k", "m").agg(F.count(F.lit(1)).alias("c"), F.min("v").alias("least"))
    for f in (found, found.where("c < 20"), found.limit(0)):
        f = spark.createDataFrame(f.collect(), f.schema)
        got, want = heavy_join(rows, f, ["k", "m"], how=how), rows.join(f.drop("c"), ["k", "m"], how)
        assert got.columns == want.columns and sorted(map(str, got.collect())) == sorted(map(str, want.collect()))


def test_golay_keys_meet():
    rnd = np.random.default_rng(3)
    a = rnd.integers(0, 2**64, 400, dtype=np.uint64)
    b = a.copy()
    for i in range(len(b)):
        for bit in rnd.choice(64, rnd.integers(0, 5), replace=False):
            b[i] ^= np.uint64(1) << np.uint64(bit)
    keys = [{} for _ in range(2)]
    for k, fp in enumerate((a, b)):
        for i, key in zip(*simhash.fuzzy_keys(fp)):
            keys[k].setdefault(i, set()).add(int(key))
    assert all(keys[0][i] & keys[1][i] for i in range(len(a)))
    words = rnd.integers(0, 2**23, 5000)
    code = np.array([m << 11 | golay._remainder(m << 11) for m in range(1 << 12)])
    assert (golay.index(code) == np.arange(1 << 12)).all() and (golay.index(code ^ 0b10000000000000100000001) == np.arange(1 << 12)).all() and golay.index(words).max() < 1 << 12


@pytest.mark.parametrize("block", [20_000, 3])
def test_simhash(docs, none, block):
    got = [r.asDict() for r in simhash.near_duplicates(docs, block=block).collect()]
    rows = pairs_of(docs)
    fps = [simhash.fingerprint(t) for _, t in rows]
    group = list(range(len(rows)))

    def find(x):
        return x if group[x] == x else find(group[x])

    for i in range(len(rows)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= 4:
                group[find(i)] = find(j)
    least: dict = {}
    for i, (d, _) in enumerate(rows):
        least[find(i)] = min(least.get(find(i), BIG), BIG if d is None else d)
    key = lambda r: (r[0] is None, r)
    want = sorted([(d, f"{fps[i]:016x}", None if least[find(i)] == BIG else least[find(i)]) for i, (d, _) in enumerate(rows)], key=str)
    assert sorted([(r["doc_id"], r["fingerprint"], r["component_id"]) for r in got], key=str) == want
    assert simhash.near_duplicates(none).count() == 0


def groups_of(links, n):
    parent = list(range(n))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return [find(i) for i in range(n)]


def similar_links(texts, width=5, similarity=0.8):
    def own(t):
        w = [x for x in re.split(r"[\x20\x09-\x0D]+", t.translate({c: c + 32 for c in range(65, 91)})) if x]
        return {tuple(w[i : i + width]) for i in range(max(1, len(w) - width + 1))} if w else set()

    sets = [own(t) for t in texts]
    for i, a in enumerate(sets):
        for j, b in enumerate(sets[:i]):
            if a == b or (a and b and len(a & b) >= similarity * len(a | b)):
                yield i, j


def near_texts():
    """Groups of texts with some words changed, and texts that hold a common passage."""
    rnd = random.Random(31)
    out = []
    for g in range(12):
        base = prose(rnd, rnd.choice((12, 30, 80, 200))).split()
        for _ in range(rnd.randint(1, 9)):
            w = list(base)
            for _ in range(rnd.randint(0, max(1, len(base) // 25))):
                w[rnd.randrange(len(w))] = rnd.choice(VOCAB)
            out.append(" ".join(w))
    passage = prose(rnd, 60)
    out += [f"{passage} {prose(rnd, 25)}" for _ in range(15)] + [prose(rnd, 50) for _ in range(10)]
    out += ["A b", "a  B\n", "a b c d e", "A b c d E", "a b c d e f", "", " \n", "one", "two"]
    return out


@pytest.mark.parametrize("block", [2000, 3])
def test_near_copies(spark, none, block):
    texts = near_texts()
    rows = [(1000 - i, t) for i, t in enumerate(texts)] + [(1000, texts[0]), (None, texts[3]), (None, "alone as can be"), (5, None)]
    d = spark.createDataFrame([(i, t, 1, 2, "r", "l", "f") for i, t in rows], SCHEMA).repartition(4)
    all_texts = [t or "" for _, t in rows]
    want = groups_of(similar_links(all_texts), len(rows))
    ids = sorted((str(i), t) for (i, _), t in zip(rows, all_texts))
    grp: dict = {}
    got = near_copies.similar_groups(d, block=block).collect()
    assert sorted(str(r.doc_id) for r in got) == [i for i, _ in ids]
    h = {r.h: r.t for r in d.select(F.xxhash64(F.coalesce("text", F.lit(""))).alias("h"), F.coalesce("text", F.lit("")).alias("t")).collect()}
    for r in got:
        grp.setdefault(r.grp, set()).add((str(r.doc_id), h[r.h]))
    brute: dict = {}
    for g, (i, _), t in zip(want, rows, all_texts):
        brute.setdefault(g, set()).add((str(i), t))
    assert sorted(map(sorted, grp.values())) == sorted(map(sorted, brute.values()))
    kept = near_copies.keep_first(d, block=block)
    first = lambda s: min(s, key=lambda x: (x[0] == "None", 0 if x[0] == "None" else int(x[0])))[0]
    assert kept.columns == d.columns and sorted(str(r.doc_id) for r in kept.collect()) == sorted(first(s) for s in brute.values())
    assert near_copies.keep_first(none).count() == 0 and near_copies.keep_first(none).schema == none.schema


def test_bands_of_similar_sets_meet():
    rnd = np.random.default_rng(5)
    for n in (1, 9, 45, 900):
        for _ in range(300):
            a = rnd.integers(0, 2**64, n, dtype=np.uint64)
            k = n - int(n / 9)  # n / 9 of either are its own: a similarity of 0.8
            b = np.concatenate([a[:k], rnd.integers(0, 2**64, n - k, dtype=np.uint64)])
            assert set(near_copies.band_keys(np.unique(a))) & set(near_copies.band_keys(np.unique(b)))


def test_fingerprint_by_hand():
    import xxhash

    text = "One two  three\nfour five two three four five ONE"
    w = text.lower().split()
    hs = [xxhash.xxh64_intdigest(" ".join(w[i : i + 4]).encode(), 42) for i in range(len(w) - 3)]
    assert simhash.fingerprint(text) == sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))
    assert simhash.fingerprint("A b") == xxhash.xxh64_intdigest(b"a b", 42) and simhash.fingerprint(" \n") == 0


def test_exact(docs, none):
    rows = pairs_of(docs)
    bare = lambda t: "".join(c for c in t if c not in " \t\n\x0b\x0c\r")
    groups: dict = {}
    for d, t in rows:
        groups.setdefault(bare(t), []).append((-len(t), d is None, d))
    got = exact_dedup.radix_groups(docs).collect()
    want = sorted((str(d), str(min(groups[bare(t)])[2]), len(groups[bare(t)]), hashlib.sha256(bare(t).encode()).hexdigest()) for d, t in rows)
    assert sorted((str(r.doc_id), str(r.keep_id), r.group_size, r.text_sha256) for r in got) == want
    assert sum(r.kept for r in got) == len(groups) and all(r.doc_id == r.keep_id for r in got if r.kept)
    assert exact_dedup.radix_groups(none).count() == 0


def brute_lines(rows, min_lines):
    """(doc_id, text, hash) -> what is left of each distinct (doc_id, text), with its lines, removed lines and runs of these."""
    seen, out = set(), {}
    for d, t, _ in sorted(set(rows), key=lambda r: (r[0] is None, r[0] or 0, r[2])):
        lines = t.split("\n")
        own = [(i, x.strip(" \t\n\x0b\x0c\r")) for i, x in enumerate(lines) if x.strip(" \t\n\x0b\x0c\r")]
        gone = set()
        for s in range(len(own) - min_lines + 1):
            k = tuple(x for _, x in own[s : s + min_lines])
            if k in seen:
                gone |= {i for i, _ in own[s : s + min_lines]}
            seen.add(k)
        marks = "".join("x" if i in gone else "." for i, _ in own)
        out[d, t] = ("\n".join(x for i, x in enumerate(lines) if i not in gone), len(own), len(gone), len(re.findall("x+", marks)))
    return out


def hashed(docs):
    return [(r.doc_id, r.t, r.h) for r in docs.select("doc_id", F.coalesce("text", F.lit("")).alias("t")).withColumn("h", F.xxhash64("t")).collect()]


def test_exact_with_ids_of_strings(spark):
    rows = [("b", "x y"), ("a", "xy"), ("c", "xy"), (None, "x  y "), ("d", "z"), ("a", "xy")]
    got = sorted((str(r.doc_id), r.keep_id, r.group_size, r.kept) for r in exact_dedup.radix_groups(spark.createDataFrame(rows, "doc_id string, text string")).collect())
    assert got == [("None", None, 5, True), ("a", None, 5, False), ("a", None, 5, False), ("b", None, 5, False), ("c", None, 5, False), ("d", "d", 1, True)]


@pytest.mark.parametrize("min_lines", [1, 2, 3])
def test_lines(spark, docs, none, min_lines):
    rnd = random.Random(14)
    few = [prose(rnd, 3) for _ in range(6)]
    more = [(i, "\n".join(rnd.choice((*few, "", "  ", f" {few[0]}\t")) for _ in range(rnd.randint(0, 9)))) for i in (*range(700, 740), 705, 705, None, None)]
    for d in (docs, spark.createDataFrame([(i, t, 1, 2, "r", "l", "f") for i, t in more], SCHEMA).repartition(3)):
        rows = hashed(d)
        want = brute_lines(rows, min_lines)
        out = line_dedup.dedup_lines(d, min_lines=min_lines)
        got = out.select("row.*", F.col("text").alias("new"), "n_lines", "n_removed", "n_runs").collect()
        assert sorted((str(r.doc_id), r.text or "", r.new, r.n_lines, r.n_removed, r.n_runs) for r in got) == sorted((str(i), t, *want[i, t]) for i, t, _ in rows)
        assert all((r.fp, r.gid, r.row, r.lines, r.first) == (1, 2, "r", "l", "f") for r in got)
    assert line_dedup.dedup_lines(none, min_lines=min_lines).count() == 0


def test_matches_extend_both_ways():
    own, first = [9, 1, 2, 3, 4, 8], [7, 1, 2, 3, 4, 5]
    assert line_dedup._extend(own, first, [{"s": 2, "f": 2}], 2) == [1, 2, 3, 4]
    assert line_dedup._extend([1, 1, 1, 1], [1, 1, 1, 1], [{"s": 1, "f": 0}], 2) == [1, 2, 3]
    assert line_dedup._extend(own, [3, 4, 8], [{"s": 3, "f": 0}], 2) == [3, 4, 5]


def test_single_lines_go(spark):
    line, alone = "one line that many texts hold between other lines", "a text of one line"
    rows = [(1, f"a b\n{line}\nc d"), (2, f"e f\n{line} \ng h\ne f"), (3, alone), (4, f" {alone}"), (5, f"{alone}\nnew")]
    d = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: (r.text, r.n_lines, r.n_removed) for r in line_dedup.dedup_lines(d).collect()}
    assert got == {1: (rows[0][1], 3, 0), 2: ("e f\ng h", 4, 2), 3: (alone, 1, 0), 4: ("", 1, 1), 5: ("new", 2, 1)}


def brute_passages(rows, width):
    first: dict = {}
    for d, t in rows:
        b = t.encode()
        for g in {b[k : k + width] for k in range(len(b) - width + 1)}:
            first[g] = min(first.get(g, BIG), BIG if d is None else d)
    out = []
    for d, t in rows:
        b = t.encode()
        gone = np.zeros(len(b) + 1, bool)
        for k in range(len(b) - width + 1):
            if first[b[k : k + width]] < (BIG if d is None else d):
                gone[k : k + width] = True
        kept = bytes(x for x, g in zip(b, gone) if not g)
        out.append((str(d), len(b), len(b) - len(kept), int((gone[1:].astype(int) - gone[:-1] == 1).sum() + gone[0]), hashlib.sha256(kept).hexdigest()))
    return sorted(out)


@pytest.mark.parametrize("width", [16, 50])
def test_passages(docs, none, width):
    got = suffix.repeated_passages(docs, width=width, buckets=7).collect()
    assert sorted((str(r.doc_id), r.n_bytes, r.n_removed, len(r.spans), r.kept_sha256) for r in got) == brute_passages(pairs_of(docs), width)
    assert all(hashlib.sha256(bytes(r.kept)).hexdigest() == r.kept_sha256 for r in got)
    assert suffix.repeated_passages(none).count() == 0


def test_passages_of_a_whole_table(spark):
    d = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    got = suffix.repeated_passages(d, contents=False).collect()
    assert sorted((str(r.doc_id), r.n_bytes, r.n_removed, len(r.spans), r.kept_sha256) for r in got) == brute_passages(pairs_of(d), 50)


def test_maximal_repeats():
    strings = [b"xxabcdefghijklmnopqrstuvw1", b"yyabcdefghijklmnopqrstuvw2", b"zzabcdefghijklmnopqrs3", b"xxabcdefghijklmnopqrs4"]
    sa, lcp, text, start = suffix.sort_suffixes(strings, 16)
    left = np.array([text[i - 1] if i not in start else -1 - i for i in sa.tolist()], np.int64)
    joined = b"".join(strings)
    groups = {joined[sa[lo] : sa[lo] + n]: hi - lo + 1 for n, lo, hi in suffix.maximal_repeats(sa, lcp, left)}
    assert groups == {b"abcdefghijklmnopqrs": 4, b"abcdefghijklmnopqrstuvw": 2, b"xxabcdefghijklmnopqrs": 2}


def brute_ends(data, least, bits, most):
    """Cut points by rolling the gear hash a byte at a time."""
    gear, h, marks, ends, last = [int(x) for x in chunks._gear()], 0, [], [], 0
    for i, c in enumerate(data):
        h = (2 * h + gear[c]) % 2**32
        if h >> (32 - bits) == 0:
            marks.append(i + 1)
    inside = lambda e: e < len(data) and data[e] & 0xC0 == 0x80
    for e in [*marks, len(data)]:
        while e - last > most:
            cut = last + most
            while cut > last + 1 and inside(cut):
                cut -= 1
            ends.append(cut)
            last = cut
        if e > last and (e == len(data) or (e - last >= least and not inside(e))):
            ends.append(e)
            last = e
    return ends


@pytest.mark.parametrize("size", [{}, queries.CHUNKS])
def test_chunks(docs, none, size):
    options = {"least": 32, "bits": 6, "most": 256, **size}
    rows, places = hashed(docs), {}
    for d, t, h in set(rows):
        b, at = t.encode(), 0
        ends = brute_ends(b, **options)
        assert ends == chunks.chunk_ends(b, **options)
        for e in ends:
            if e - at >= options["least"]:
                places.setdefault(b[at:e], []).append((d is None, d or 0, h, at))
            at = e
        assert at == len(b)
    first = {k: min(v) for k, v in places.items()}
    want = []
    for d, t, h in rows:
        b, at, kept, marks = t.encode(), 0, [], ""
        for e in brute_ends(b, **options):
            gone = e - at >= options["least"] and first[b[at:e]] < (d is None, d or 0, h, at)
            marks += "x" if gone else "."
            kept += [] if gone else [b[at:e]]
            at = e
        left = b"".join(kept)
        want.append((str(d), left.decode(), len(b), len(b) - len(left), len(re.findall("x+", marks))))
    assert sorted((str(r.doc_id), r.text, r.n_bytes, r.n_removed, r.n_spans) for r in chunks.dedup_chunks(docs, **options).collect()) == sorted(want)
    assert chunks.dedup_chunks(none, **options).count() == 0


def test_chunks_resist_shifts():
    rnd = random.Random(9)
    a = prose(rnd, 2000).encode()
    b = a[:500] + b"an insertion" + a[500:]
    cut = lambda x: {x[s:e] for s, e in zip([0, *chunks.chunk_ends(x)], chunks.chunk_ends(x))}
    assert len(cut(b) - cut(a)) <= 4


def test_chunks_of_the_query_catch_passages(spark, tmp_path):
    rnd = random.Random(12)
    passages = [prose(rnd, 60) for _ in range(100)]
    rows = [(i, f"{prose(rnd, 20)} {p} {prose(rnd, 20)}") for i, p in enumerate(passages + passages)]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    removed = {r.doc_id: r.n_removed for r in queries.op7_chunks(spark, str(tmp_path)).collect()}
    assert all(removed[i] == 0 < removed[100 + i] for i in range(100)) and sum(removed.values()) >= 0.65 * sum(map(len, passages))


def test_warc(spark, none):
    rnd = random.Random(4)
    big = prose(rnd, 60_000)
    rows = [(5, "http://a", "x"), (3, "http://b c\r\nd", "x"), (9, None, None), (2, "u", ""), (7, "u", big), (8, "v", big), (8, "v", big), (None, "n", "x"), (11, "w", "é😀")]
    pages = spark.createDataFrame([(*r, "k") for r in rows], "page_id long, url string, html string, sha1 string").repartition(3)
    got = warc.round_trip(pages, chunk=1000, contents=True).collect()
    last = sorted((str(r.record_id), r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in got if r["last"])
    ids: dict = {}
    for i, _, h in rows:
        ids.setdefault(h or "", []).append(i)
    want = []
    for i, _, h in rows:
        first = min(x for x in ids[h or ""] if x is not None)
        b = (h or "").encode()
        want.append((str(i), len(b), b32encode(hashlib.sha1(b).digest()).decode(), "response" if i == first else "revisit", None if i == first else str(first)))
    assert last == sorted(want)
    parts = sorted((r.chunk_no, bytes(r.chunk), r.bytes_so_far, r.digest_so_far) for r in got if r.record_id == "7")
    sha, so_far = hashlib.sha1(), 0
    for no, (k, c, n, d) in enumerate(parts):
        sha.update(c)
        so_far += len(c)
        assert (k, n, d) == (no, so_far, b32encode(sha.copy().digest()).decode()) and len(c) <= 1000
    assert b"".join(c for _, c, _, _ in parts) == big.encode()
    assert warc.round_trip(pages.limit(0)).count() == 0
    assert all(r.record_type == "response" for r in warc.round_trip(pages, least=10**9).where("last").collect())


def test_warc_long_payloads(spark):
    long = ["".join(random.Random(k).choice("abc é") for _ in range(400_000)) for k in range(2)]
    pages = spark.createDataFrame([(1, "u", long[0]), (2, "v", long[1]), (3, "w", long[0])], "page_id long, url string, html string")
    got = warc.round_trip(pages, contents=True).collect()
    for i, t in ((1, long[0]), (2, long[1])):
        parts = sorted((r.chunk_no, bytes(r.chunk), r["last"]) for r in got if r.record_id == str(i))
        assert [n for n, _, _ in parts] == list(range(len(parts))) and len(parts) > 6 and [x for _, _, x in parts] == [False] * (len(parts) - 1) + [True]
        assert b"".join(c for _, c, _ in parts) == t.encode() and all(len(c) == warc.CHUNK for _, c, _ in parts[:-1])
    assert [(r.record_type, r.refers_to, r.payload_bytes) for r in got if r.record_id == "3"] == [("revisit", "1", len(long[0].encode()))]
    longest = warc.chunk_table(pages).agg(F.max(F.octet_length("chunk"))).first()[0]
    assert longest == warc.CHUNK


def test_warc_streams_payloads_and_lists_archives_without_files(spark, tmp_path, monkeypatch):
    batch, seen, cores = "spark.sql.parquet.columnarReaderBatchSize", [], spark.sparkContext.defaultParallelism
    conf = {"spark.sql.shuffle.partitions": "64", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before, read = {k: spark.conf.get(k) for k in conf}, spark.conf.get(batch)
    rows = [(i, f"u{i}", None if i % 50 == 0 else f"page {i % 150} " * 40) for i in range(400)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    first = {h or "": i for i, _, h in reversed(rows)}
    want = sorted((str(i), None if first[h or ""] == i else str(first[h or ""]), len(h or "")) for i, _, h in rows)
    of = lambda d: sorted((r.record_id, r.refers_to, r.payload_bytes) for r in d.where("last").collect())
    plan = lambda: warc.chunk_table(pages)._jdf.queryExecution().executedPlan().toString()
    monkeypatch.setattr(tables, "shared_dir", lambda s: f"file://{tmp_path}")
    own = type(pages).toArrow
    monkeypatch.setattr(type(pages), "toArrow", lambda d: (seen.append(int(spark.conf.get(batch))), own(d))[1])
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        assert "SortMergeJoin" not in plan() and "Sort [" not in plan()
        got = warc.round_trip(pages)
        files = [f for f in tmp_path.rglob("*") if f.is_file()]
        assert len(files) > cores and all(f.name.endswith(".warc.gz") for f in files)
        assert seen == [512] and spark.conf.get(batch) == read
        assert got.rdd.getNumPartitions() <= cores and of(got) == want  # however many the shuffle partitions
        monkeypatch.setattr(warc, "READ", 1)
        assert warc.round_trip(pages).rdd.getNumPartitions() > cores
        monkeypatch.setattr(warc, "KEYS", 2)  # 400 rows might be 200 repeated payloads, 64 partitions of 2 hold 128
        assert "SortMergeJoin" in plan() and "ShuffledHashJoin" not in plan()
        assert of(warc.round_trip(pages)) == want
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_quality(spark):
    rnd = random.Random(6)
    rows, labels = [], []
    for i in range(600):
        bad = i % 4 == 0
        t = prose(rnd, rnd.randint(5, 80))
        rows.append((i, t.upper().replace(" ", "!! ") if bad and i % 8 else " | ".join(t.split()) if bad else t.capitalize() + ".", 0.5))
        labels.append((i, 0 if bad else 1, 0))
    rows += [(None, None, 0.1), (601, "", 0.1)]
    d, l = spark.createDataFrame(rows, "doc_id long, text string, score double"), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    got = {r.doc_id: r for r in quality.classify(d, l).collect()}
    assert all(r.held_out == (zlib.crc32(str("" if i is None else i).encode()) % 5 == 0) and r.predicted == int(r.score >= 0.3) and 0 <= r.score <= 1 for i, r in got.items())
    held = [i for i in range(600) if got[i].held_out]
    assert sum(got[i].predicted == labels[i][1] for i in held) >= 0.97 * len(held)
    assert quality.classify(d.limit(0), l).count() == 0
    assert {r.score for r in quality.classify(d, l.limit(0)).collect()} == {0.5}
    flipped = l.withColumn("quality", F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0, 1 - F.col("quality")).otherwise(F.col("quality")))
    assert {r.doc_id: r.score for r in quality.classify(d, flipped).collect()} == {i: r.score for i, r in got.items()}


def by_hand(model, text):
    """A score by one addition after another of what the tables have for each feature's bin."""
    x = quality.features(text)
    bins = [sum(v >= e for e in edges) for v, edges in zip(x, model.edges)]
    total = model.base
    for b, t in zip(bins, model.tables):
        total += float(t[b])
    for (i, j), t in zip(model.pairs, model.pair_tables):
        total += float(t[bins[i], bins[j]])
    return 1 / (1 + math.exp(-max(-30.0, min(30.0, total))))


def test_quality_scores_by_hand(spark):
    rnd = random.Random(16)
    texts = ["", None, " \n", "word", prose(rnd, 60_000), "X" * 200_000, "é😀 " * 50, "a\n" * 3000] + [prose(rnd, rnd.randint(1, 60)).upper() if k % 3 == 0 else prose(rnd, rnd.randint(1, 60)) for k in range(80)]
    rows = [(k, t, 7) for k, t in enumerate(texts)] + [(3, "word", 7), (3, "word", 7), (3, "other"[:5], 7), (None, "word", 7)]
    d = spark.createDataFrame(rows, "doc_id long, text string, score int")
    labels = spark.createDataFrame([(k, int(k % 3 != 0), 0) for k in range(8, 88)] + [(9, 1, 0), (9, None, 0), (None, 1, 0), (10, 5, 0)], "doc_id long, quality int, toxic int")
    model = quality.learn(quality.feature_table(d), labels)
    assert model.tables and model.pairs
    got = sorted((str(r.doc_id), round(r.score, 9), r.predicted, r.held_out) for r in quality.classify(d, labels).collect())
    score = lambda t: by_hand(model, t or "")
    held = lambda i: zlib.crc32(str("" if i is None else i).encode()) % 5 == 0
    assert got == sorted((str(i), round(score(t), 9), int(score(t) >= 0.3), held(i)) for i, t, _ in rows)
    tied = quality.classify(d.where("doc_id = 3 and text = 'word'"), labels).collect()
    assert len(tied) == 3 and len({r.score for r in tied}) == 1


def test_pairs_fold_into_tables():
    rnd = np.random.default_rng(2)
    x = rnd.random((4000, 3))
    y = ((x[:, 0] > 0.5) ^ (x[:, 1] > 0.5)).astype(float)
    m = quality.fit(x, y)
    assert (0, 1) in [tuple(sorted(p)) for p in m.pairs] and ((m.score(x) > 0.5) == y).mean() > 0.9


def brute_contaminated(rows, items, threshold=0.6, overlap=0.8, k1=1.2, b=0.75):
    """Pairs whose BM25 score, worked out from the items' counts for each passage, and shingle shares reach their thresholds."""
    split = lambda t: re.sub(r"[\x00-/:-@\[-`{-\x7f]", " ", (t or "").lower()).split()
    own = [(i, split(t), t) for i, t in items if split(t)]
    mean = sum(len(w) for _, w, _ in own) / max(1, len(own))
    df: dict = {}
    for _, w, _ in own:
        for x in set(w):
            df[x] = df.get(x, 0) + 1
    step, out = max([64, *(len(w) for _, w, _ in own)]), set()
    weight = {}
    for i, w, t in own:
        for x in set(w):
            tf = w.count(x)
            weight[i, t, x] = math.log(1 + (len(own) - df[x] + 0.5) / (df[x] + 0.5)) * tf * (k1 + 1) / (tf + k1 * (1 - b + b * len(w) / mean))
    runs = lambda w: {tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))} if w else set()
    for d, text in rows:
        words = split(text)
        have = {n: {tuple(words[k : k + n]) for k in range(len(words) - n + 1)} for n in range(1, 6)}
        for i, w, t in own:
            total = sum(weight[i, t, x] for x in set(w))
            best = max(sum(weight[i, t, x] for x in set(words[p : p + 2 * step]) & set(w)) / total for p in range(0, len(words) + 1, step))
            head, _, tail = t.partition("?")
            q, a = split(head), split(tail)
            parts = [runs(q), runs(a)] if q and a else [runs(w)]
            if best >= threshold - 1e-9 and all(sum(s in have[len(s)] for s in p) / len(p) >= overlap - 1e-9 for p in parts):
                out.add((d, i))
    return out


@pytest.mark.parametrize("kind", ["int", "string", "long"])
def test_decontaminate_ids_of_any_type(spark, kind):
    words = [f"w{k}" for k in range(12)]
    bench = spark.createDataFrame([("7", " ".join(words)), (None, "quite another text of some more words")], "item_id string, text string").withColumn("item_id", F.col("item_id").cast(kind))
    d = spark.createDataFrame([("3", "before " + " ".join(words)), ("4", "clean"), (None, " ".join(words))], "doc_id string, text string").withColumn("doc_id", F.col("doc_id").cast(kind))
    out = decontaminate.contaminated(d, bench)
    assert sorted((str(r.doc_id), str(r.item_id)) for r in out.collect()) == [("3", "7"), ("None", "7")] and out.schema["item_id"].dataType.simpleString() == {"long": "bigint"}.get(kind, kind)
    assert [str(r.doc_id) for r in decontaminate.clean(d, bench).collect()] == ["4"]


def test_long_items_have_an_index_of_their_own(spark):
    items = [(1, "one two three four five six"), (2, "x " * 3000 + "the end of it"), (3, "seven eight nine ten eleven")]
    parts = list(decontaminate._slices(spark.createDataFrame(items, "item_id long, text string"), "item_id", "text", 20_000))
    assert [[i for i, _ in p] for p in parts] == [[1, 3], [2]]


def test_decontaminate(spark, docs, none):
    rnd = random.Random(8)
    items = [(i, prose(rnd, rnd.randint(8, 40)).replace(" ", "? ", 1) if i % 3 == 0 else prose(rnd, rnd.randint(3, 90))) for i in range(40)] + [(100, None), (101, ""), (102, items_text := "solely these words make the item up for once")]
    bench = spark.createDataFrame(items, "item_id long, text string")
    rows = [(i, prose(rnd, rnd.randint(0, 400)) + " " + (items[i % 40][1].upper() if i % 2 else "") + ", " + prose(rnd, 30)) for i in range(60)] + [(77, items_text), (78, None), (79, " ".join(items_text.split()[:5])), (None, items_text)]
    d = spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, item_id long")
    got = {(r.doc_id, r.item_id) for r in decontaminate.contaminated(d, bench).collect()}
    want = brute_contaminated(rows, items)
    assert got == want and {(77, 102), (None, 102)} <= got and len(got) >= 25
    assert {(r.doc_id, r.item_id) for r in decontaminate.contaminated(d, bench, size=7).collect()} == got
    assert decontaminate.contaminated(none, bench).count() == 0 and decontaminate.contaminated(d, bench.limit(0)).count() == 0
    bad = {i for i, _ in got}
    assert sorted(str(r.doc_id) for r in decontaminate.clean(d, bench, size=15).collect()) == sorted(str(i) for i, _ in rows if i not in bad)


def test_decontaminate_with_a_changed_word(spark):
    item = [f"w{k}" for k in range(30)]
    changed = lambda *at: " ".join("other" if k in at else x for k, x in enumerate(item))
    bench = spark.createDataFrame([(1, " ".join(item)), (2, "q1 q2 q3 q4 q5 q6 q7? a1 a2 a3 a4 a5 a6 a7")], "item_id long, text string")
    rows = [(1, "before " + changed(7) + " after"), (2, changed(7, 20)), (3, "q1 q2 q3 q4 q5 q6 q7 a1 a2 a3 other a5 a6 a7"), (4, "q1 q2 q3 q4 q5 q6 q7 a1 a2 a3 a4 a5 a6 a7")]
    got = {(r.doc_id, r.item_id): (r.question_overlap, r.answer_overlap) for r in decontaminate.contaminated(spark.createDataFrame(rows, "doc_id long, text string"), bench).collect()}
    assert got == {(1, 1): (21 / 26, 1.0), (4, 2): (1.0, 1.0)}


def test_preference(spark):
    turns = [(1, 0, "user", "hi"), (1, 1, "assistant", "one"), (1, 2, "user", "more <|end|>"), (1, 3, "assistant", "two"), (2, 0, "user", None), (3, 0, "user", "q"), (3, 1, "assistant", "a"), (3, 2, "user", "thanks"), (4, None, None, "x")]
    t = spark.createDataFrame([(*r, "z") for r in turns], "conv_id long, turn long, role string, text string, prompt string")
    got = {r.pair_id: r for r in preference.format_pairs(preference.self_negatives(preference.conversations(t))).collect()}
    assert got[1].n_prompt_turns == 3 and got[1].prompt.count("<|user|>") == 2 and got[1].chosen == "<|assistant|>\ntwo<|end|>\n" and got[1].rejected == "<|assistant|>\none<|end|>\n"
    s = got[1].chosen_mask[0]
    assert got[1].chosen[s.start : s.end] == "two<|end|>" and "< |end|>" in got[1].prompt
    assert got[2].chosen == got[2].rejected == "" and got[2].chosen_mask == [] and got[3].rejected == f"<|assistant|>\n{preference.REFUSAL}<|end|>\n"
    p = spark.createDataFrame([(1, [("user", "a")], [("user", "b"), ("assistant", "c")]), (2, None, [("user", None)])], "pair_id long, chosen array<struct<role:string,text:string>>, rejected array<struct<role:string,text:string>>")
    out = {r.pair_id: r for r in preference.format_pairs(p).collect()}
    assert out[1].n_prompt_turns == 0 and out[1].prompt == "" and out[1].chosen_mask == [] and len(out[1].rejected_mask) == 1 and out[2].chosen == ""
    assert preference.format_pairs(p.limit(0)).count() == 0


def test_conversations_of_odd_turns(spark):
    turns = [(None, 1, "user", "a"), (None, 2, "assistant", "b"), (5, 2, "assistant", "late"), (5, 1, "user", "u2"), (5, 1, "user", "u1"), (5, None, "system", None), (6, 1, None, "x"), (6, 1, None, "x")]
    t = spark.createDataFrame([(*r, 9) for r in turns], "conv_id long, turn long, role string, text string, turns int")
    got = sorted((str(r.conv_id), [tuple(x) for x in r.turns]) for r in preference.conversations(t).collect())
    assert got == [("5", [("system", ""), ("user", "u1"), ("user", "u2"), ("assistant", "late")]), ("6", [("", "x"), ("", "x")]), ("None", [("assistant", "b")]), ("None", [("user", "a")])]
    assert preference.conversations(t.limit(0)).count() == 0 and preference.self_negatives(preference.conversations(t.limit(0))).count() == 0
    pairs = {str(r.pair_id): r for r in preference.self_negatives(preference.conversations(t)).where("pair_id is not null").collect()}
    assert pairs["5"].rejected[-1].text == preference.REFUSAL and pairs["6"].chosen == pairs["6"].rejected


def test_pairs_against_brute_force(spark):
    rnd = random.Random(21)

    def turn():
        return rnd.choice([("user", "hi"), ("assistant", "one"), ("assistant", "tw<|o"), ("system", ""), ("user", None), (None, "é😀")])

    rows = []
    for i in range(120):
        head = [turn() for _ in range(rnd.randint(0, 4))]
        rows.append((i % 100, head + [turn() for _ in range(rnd.randint(0, 3))], head + [turn() for _ in range(rnd.randint(0, 3))], "k"))
    kind = "array<struct<role:string,text:string>>"
    d = spark.createDataFrame(rows, f"pair_id long, chosen {kind}, rejected {kind}, prompt string")

    def show(ts):
        text, spans = "", []
        for role, said in ts:
            head = f"<|{role.replace('<|', '< |')}|>\n"
            body = said.replace("<|", "< |") + "<|end|>"
            if role == "assistant":
                spans.append((len(text) + len(head), len(text) + len(head) + len(body)))
            text += head + body + "\n"
        return text, spans

    want = []
    for i, c, r, _ in rows:
        c, r = ([(a or "", b or "") for a, b in x] for x in (c, r))
        n = next((k for k, (a, b) in enumerate(zip(c, r)) if a != b), min(len(c), len(r)))
        want.append((i, n, show(c[:n])[0], *show(c[n:]), *show(r[n:])))
    spans = lambda m: [(x.start, x.end) for x in m]
    got = [(r.pair_id, r.n_prompt_turns, r.prompt, r.chosen, spans(r.chosen_mask), r.rejected, spans(r.rejected_mask)) for r in preference.format_pairs(d).collect()]
    assert sorted(got) == sorted(want)


def test_packing(docs, none):
    path = public_tokenizers.path("byte_bpe_50k.json")
    got = packing.pack_documents(docs, path, capacity=64, keep_ids=True, groups=16).collect()
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(path)
    want = sorted((str(d), [*tok.encode(t, add_special_tokens=False).ids, 2]) for d, t in pairs_of(docs))
    by: dict = {}
    for r in got:
        assert r.length == len(r.ids) <= 64 and r.ids_crc32 == zlib.crc32(np.array(r.ids, "<u4").tobytes())
        by.setdefault((str(r.doc_id), r.piece), []).append(r)
    total = sum(len(x) for _, x in want)
    assert sum(r.length for r in got) == total and all(r.length == 64 for r in got if r.piece > 0)
    single = {d for d, _ in want if sum(d == e for e, _ in want) == 1}
    for d, ids in want:
        if d in single:
            k = sorted((r.piece, r.start, r.ids) for (e, _), rs in by.items() if e == d for r in rs)
            assert [i for _, _, x in k for i in x] == ids and [s for _, s, _ in k] == [sum(len(x) for _, _, x in k[:j]) for j in range(len(k))]
    seqs: dict = {}
    for r in got:
        seqs.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for s in seqs.values():
        at = 0
        for o, n in sorted(s):
            assert o == at
            at += n
        assert at <= 64
    assert len(seqs) <= 1.03 * total / 64 + 2
    assert packing.pack_documents(none, path).count() == 0


def test_packing_deals_tasks_by_rows(spark, docs, monkeypatch):
    path, batch, seen = public_tokenizers.path("byte_bpe_50k.json"), "spark.sql.parquet.columnarReaderBatchSize", []
    conf = {"spark.sql.shuffle.partitions": "64", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before, read, cores = {k: spark.conf.get(k) for k in conf}, spark.conf.get(batch), spark.sparkContext.defaultParallelism
    rows = lambda d: sorted(d.select(F.col("doc_id").cast("string"), "piece", "start", "length", "ids_crc32").collect(), key=str)
    own = packing.materialize
    monkeypatch.setattr(packing, "materialize", lambda *a: (seen.append(int(spark.conf.get(batch))), own(*a))[1])
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        got = packing.pack_documents(docs, path, capacity=64)
        assert got.rdd.getNumPartitions() <= 2 * cores  # however many the shuffle partitions
        assert seen == [512] and spark.conf.get(batch) == read
        want = rows(packing.token_pieces(docs, path, 64))
        assert rows(got) == want
        monkeypatch.setattr(packing, "ROWS", len(want) // (3 * cores))
        more = packing.pack_documents(docs, path, capacity=64)
        assert more.rdd.getNumPartitions() > 2 * cores and rows(more) == want
        placed = lambda d: sorted(map(tuple, d.where("length < 64").select("doc_id", "piece", "length", "ids_crc32", "sequence_id", "offset").collect()), key=str)
        assert placed(more) == placed(got)
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_ids_are_those_of_the_library():
    path = public_tokenizers.path("byte_bpe_50k.json")
    from tokenizers import Tokenizer

    tok, rnd = Tokenizer.from_file(path), random.Random(8)
    odd = [chr(c) for c in (0x20, 0x20, 0x0A, 0x0B, 0x1C, 0x85, 0xA0, 0x200B, 0x2028, 0x3000, 0xE9, 0x301, 0x4E2D, 0x1F600, 0x27, 0x73, 0x31, 0xBD, 0x41, 0x62)]
    texts = ["", "<|endoftext|>", "a <|endoftext|> b", "<|endoftext|><|endoftext|>", " <|endoftext|>\n\n x", "<|endoftext", prose(rnd, 50) + "<|endoftext|>" + prose(rnd, 50)]
    texts += ["".join(rnd.choice(odd) for _ in range(rnd.randint(1, 30))) for _ in range(2000)]
    texts += ["".join(rnd.choice("etaoinshrdlu ") for _ in range(rnd.randint(1, 60))) for _ in range(2000)]
    for t, ids in zip(texts, packing.encoder(path)(texts), strict=True):
        assert ids.tolist() == tok.encode(t, add_special_tokens=False).ids


def test_configurations_fill_sequences():
    for sizes, counts, most in (([512, 300, 212], [10, 10, 10], 10.01), ([700, 324], [8, 8], 8.01), ([342], [9], 4.51), ([600, 400], [1, 9], 5.01)):
        found = packing.configurations(sizes, counts, 1024)
        assert sum(t for _, t in found) <= most and all(sum(s * m for s, m in zip(sizes, p)) <= 1024 for p, _ in found)
        assert all(sum(p[i] * t for p, t in found) >= c - 1e-6 for i, c in enumerate(counts))


def test_plan_against_search():
    """Few documents: as few sequences as any packing has."""
    rnd = random.Random(23)

    def fewest(items, room):
        best = [len(items)]

        def put(k, bins):
            if len(bins) >= best[0]:
                return
            if k == len(items):
                best[0] = len(bins)
                return
            for i in range(len(bins)):
                if bins[i] >= items[k] and bins[i] not in bins[:i]:
                    put(k + 1, [*bins[:i], bins[i] - items[k], *bins[i + 1 :]])
            put(k + 1, [*bins, room - items[k]])

        put(0, [])
        return best[0]

    extra = 0
    for _ in range(40):
        items = sorted((rnd.randint(1, 64) for _ in range(rnd.randint(1, 11))), reverse=True)
        counts = {n: items.count(n) for n in items}
        extra += packing.Plan(counts, capacity=64).sequences - fewest(items, 64)
    assert 0 <= extra <= 4


def test_plan_places_all():
    rnd = random.Random(3)
    counts: dict = {}
    for _ in range(20_000):
        n = rnd.randint(1, 1024)
        counts[n] = counts.get(n, 0) + 1
    p = packing.Plan(counts)
    fill: dict = {}
    seen: dict = {}
    for length, rank, n, seq, offset in p.rows:
        assert seen.get(length, 0) == rank
        seen[length] = rank + n
        for k in range(n):
            fill.setdefault(seq + k, []).append((offset, length))
    assert seen == counts and len(fill) == p.sequences <= 1.01 * sum(k * v for k, v in counts.items()) / 1024 + 1
    for s in fill.values():
        at = 0
        for o, n in sorted(s):
            assert o == at
            at += n
        assert at <= 1024
