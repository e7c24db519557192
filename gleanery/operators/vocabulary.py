"""Which tokens a corpus contains, as parts of its texts or as whole words."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..plans.tables import materialize

#: Tokens that one pass over the corpus looks for.
BLOCK = 20_000


def vocabulary(corpus: DataFrame, content: str = "content", pattern: str = r"[\w$@][\w$.:/@-]*") -> DataFrame:
    """(token): the distinct tokens of all texts, in lower case."""
    return corpus.select(F.explode(F.array_distinct(F.regexp_extract_all(F.lower(content), F.lit(pattern), F.lit(0)))).alias("token")).distinct()


def contained(tokens: DataFrame, corpus: DataFrame, content: str = "content", whole: bool = False, block: int = BLOCK) -> DataFrame:
    """Of distinct lower-case tokens (token) those that some text contains, without case; with ``whole`` between word boundaries.

    Most are tokens of a text themselves, which a join with the vocabulary tells. What is left is looked for within the texts, ``block`` tokens a
    pass, by an automaton. Null and empty tokens are in none.
    """
    tokens = materialize(tokens.where("token <> ''").select("token"), "tokens")
    words = vocabulary(corpus, content, r"\w+") if whole else vocabulary(corpus, content)
    easy = materialize(tokens.join(words, "token", "left_semi"), "tokens-known")
    rest = materialize(tokens.join(easy, "token", "left_anti"), "tokens-left")
    texts = corpus.select(F.lower(F.coalesce(F.col(content), F.lit(""))).alias("t"))
    part: list[str] = []
    out = easy
    for r in rest.toLocalIterator():
        part.append(r[0])
        if len(part) == block:
            out, part = out.unionByName(_found(texts, part, whole)), []
    if part:
        out = out.unionByName(_found(texts, part, whole))
    return out


def _found(texts: DataFrame, part: list[str], whole: bool) -> DataFrame:
    shared = texts.sparkSession.sparkContext.broadcast(part)

    def word(c: str) -> bool:
        return c.isascii() and (c.isalnum() or c == "_")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import ahocorasick

        automaton, seen = ahocorasick.Automaton(), set()
        for w in shared.value:
            automaton.add_word(w, w)
        automaton.make_automaton()
        for b in batches:
            for x in b.column(0):
                t = x.as_py()
                for end, w in automaton.iter(t):
                    if w in seen:
                        continue
                    if whole:
                        lo, hi = end - len(w) + 1, end + 1
                        if (lo > 0 and word(t[lo - 1])) == word(w[0]) or (hi < len(t) and word(t[hi])) == word(w[-1]):
                            continue
                    seen.add(w)
        yield pa.RecordBatch.from_arrays([pa.array(sorted(seen), pa.string())], names=["token"])

    return materialize(texts.mapInArrow(run, "token string").distinct(), "tokens-found")
