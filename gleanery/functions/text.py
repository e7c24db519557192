"""Text functions as native column expressions. Lengths are in code points."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Fenced code, links, and hosts of examples. Fixed values.
FENCE = r"```[\s\S]*?```"
LINK = r"https?://[^\s)>\]\"'`]+"
LOCAL = r"^https?://(localhost|127\.0\.0\.1|([a-z0-9-]+\.)*example\.[a-z]+)([:/]|\z)"


def let(value: Column, body) -> Column:
    """``body`` of a value that is worked out once, also where a lambda within it uses it many times."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def content_hash(text: Column, n: int = 10) -> Column:
    return F.substring(F.sha2(text, 256), 1, n)


def seed(text: Column, n: int = 8) -> Column:
    """A number from the first hexadecimal digits of the hash."""
    return F.conv(content_hash(text, n), 16, 10).cast("long")


def js_round(x: Column) -> Column:
    """Halves go up, also below zero."""
    return F.floor(x + F.lit(0.5))


def to_number(x: Column) -> Column:
    """A number, or 0 for what is none."""
    d = x.try_cast("double")
    return F.when(d.isNull() | F.isnan(d), F.lit(0.0)).otherwise(d)


def normalize_url(url: Column) -> Column:
    """Without fragment, with exactly one more slash at the end; a query string stays."""
    return F.concat(F.regexp_replace(F.regexp_replace(url, r"(?s)#.*\z", ""), r"/\z", ""), F.lit("/"))


def url_path(url: Column) -> Column:
    """Path without host, fragment, query and slashes at either end."""
    bare = F.regexp_replace(url, r"(?s)[#?].*\z", "")
    return F.regexp_replace(F.regexp_replace(bare, r"^[a-z]+://[^/]*/?", ""), r"/\z", "")


def path_query(path: Column) -> Column:
    """The last two segments as search words."""
    return F.translate(F.array_join(F.slice(F.reverse(F.slice(F.reverse(F.split(path, "/")), 1, 2)), 1, 2), " "), "-_", "  ")


def strip_tags(html: Column) -> Column:
    return F.trim(F.regexp_replace(F.regexp_replace(html, "<[^>]*>", ""), "&[#a-zA-Z0-9]+;", " "))


def headings(html: Column, level: str = "[23]", most: int = 25, boring: str = r"(?i)^(on this page|contents|next steps)\z") -> Column:
    """Headings of some levels without tags, empty and boring ones, the first ``most``."""
    found = F.regexp_extract_all(html, F.lit(rf"(?s)<h{level}[^>]*>(.*?)</h{level}>"), F.lit(1))
    return F.slice(F.filter(F.transform(found, strip_tags), lambda h: (h != "") & ~F.regexp_like(h, F.lit(boring))), 1, most)


def sitemap_urls(xml: Column) -> Column:
    return F.regexp_extract_all(xml, F.lit(r"<loc>\s*([^<\s]+)\s*</loc>"), F.lit(1))


def front_matter_title(text: Column) -> Column:
    return F.regexp_extract(text, r"(?m)^title:\s*[\"']?(.*?)[\"']?\s*$", 1)


def strip_front_matter(text: Column) -> Column:
    return F.regexp_replace(text, r"^---[\s\S]*?---", "")


def markdown_links(text: Column) -> Column:
    """Array of (label, target)."""
    rx = F.lit(r"\[([^\]]+)\]\(([^)\s]+)\)")
    return F.transform(F.arrays_zip(F.regexp_extract_all(text, rx, F.lit(1)).alias("label"), F.regexp_extract_all(text, rx, F.lit(2)).alias("target")), lambda x: F.struct(x["label"].alias("label"), x["target"].alias("target")))


def prose(text: Column) -> Column:
    """Without fenced code."""
    return F.regexp_replace(text, FENCE, "")


def without_inline_code(text: Column) -> Column:
    return F.regexp_replace(text, r"`[^`\n]*`", "")


def fenced_blocks(text: Column) -> Column:
    """Array of (lang, body)."""
    rx = F.lit(r"```(\w*)\n([\s\S]*?)```")
    return F.transform(F.arrays_zip(F.regexp_extract_all(text, rx, F.lit(1)).alias("lang"), F.regexp_extract_all(text, rx, F.lit(2)).alias("body")), lambda x: F.struct(x["lang"].alias("lang"), x["body"].alias("body")))


def unclosed_fence(text: Column) -> Column:
    return F.regexp_count(text, F.lit("```")) % 2 == 1


def links(text: Column) -> Column:
    """Links in prose outside inline code, without a last mark; those to local and example hosts aside."""
    found = F.regexp_extract_all(without_inline_code(prose(text)), F.lit(LINK), F.lit(0))
    return F.filter(F.transform(found, lambda x: F.regexp_replace(x, r"[.,;:]\z", "")), lambda x: ~F.regexp_like(x, F.lit(LOCAL)))


#: A named import statement: default name, names in braces, module. Fixed value.
IMPORT = r"import\s+(?:type\s+)?(?:(\w+)\s*,?\s*)?(?:\{([^}]*)\})?\s*from\s*['\"]([^'\"]+)['\"]"


def imports(body: Column) -> Column:
    """Array of (module, default, names) of the import statements in code; default and names may be empty."""
    parts = {name: F.regexp_extract_all(body, F.lit(IMPORT), F.lit(i)) for name, i in (("module", 3), ("default", 1), ("names", 2))}
    return F.transform(F.arrays_zip(*[c.alias(n) for n, c in parts.items()]), lambda x: F.struct(*[x[n].alias(n) for n in parts]))


def imported_names(names: Column, comments: bool = True) -> Column:
    """Names of an import clause, with or without its braces, without aliases and ``type``; comments are taken out first if asked for."""
    inner = F.regexp_replace(names, r"^[^{}]*\{|\}[\s\S]*\z", "")
    inner = F.regexp_replace(inner, r"//[^\n]*|/\*[\s\S]*?\*/", "") if comments else inner
    each = F.transform(F.split(inner, ","), lambda n: F.trim(F.regexp_replace(F.regexp_replace(_bare(n), r"^type\s+", ""), r"\s+as\s+[\s\S]*", "")))
    return F.filter(each, lambda n: n != "")


def _bare(text: Column) -> Column:
    return F.regexp_replace(text, r"^\s+|\s+\z", "")


def members(body: Column, owner: str) -> Column:
    """Names that follow ``owner.`` in code."""
    return F.regexp_extract_all(body, F.lit(rf"\b{owner}\.(\w+)"), F.lit(1))


def split_sections(text: Column, tag: str) -> Column:
    """Map from the number n of a line ``=====tag n=====`` (fixed format) to the text up to the next such line."""
    parts = F.split(F.concat(F.lit("\n"), text), rf"(?=\n====={tag} \d+=====)")
    rx = rf"^\n?====={tag} (\d+)=====[^\S\n]*\n\s*([\s\S]*?)\s*\z"
    entries = F.transform(F.filter(parts, lambda p: F.regexp_like(p, F.lit(rx))), lambda p: F.struct(F.regexp_extract(p, rx, 1).cast("int").alias("key"), F.regexp_extract(p, rx, 2).alias("value")))
    # of equal numbers the last counts
    fold = F.aggregate(entries, F.create_map().cast("map<int,string>"), lambda m, e: F.map_concat(F.map_filter(m, lambda k, v: k != e["key"]), F.create_map(e["key"], e["value"])))
    return fold


def loose_json(text: Column) -> Column:
    """The first JSON text within: a fence's body, else the outermost brackets, else the outermost braces; null if none parses."""
    def outer(s: Column, left: str, right: str) -> Column:
        at = F.struct(F.locate(left, s).alias("a"), F.locate(right, F.reverse(s)).alias("z"), F.length(s).alias("n"))
        return let(at, lambda p: F.when((p["a"] > 0) & (p["z"] > 0) & (p["n"] - p["z"] + 1 > p["a"]), F.substring(s, p["a"], p["n"] - p["z"] - p["a"] + 2)))

    def parsed(c: Column) -> Column:
        return let(c, lambda c: F.when(F.regexp_like(c, F.lit(r"^\s*[\[{]")) & F.try_parse_json(c).isNotNull(), c))

    # a reply is searched once, and brackets only if it doesn't parse as it is
    body = F.regexp_extract(text, r"```(?:json)?\s*([\s\S]*?)```", 1)
    whole = let(body, lambda b: F.when(b != "", b).otherwise(text))
    return let(whole, lambda s: F.trim(F.coalesce(parsed(s), parsed(outer(s, "[", "]")), parsed(outer(s, "{", "}")))))


def strip_ansi(text: Column) -> Column:
    return F.regexp_replace(text, "\u001b\\[[0-9;?]*[A-Za-z]", "")


def strip_banner(text: Column, mark: str) -> Column:
    """Without the lines above and with the last one that begins with ``mark``, a pattern of a tool's own banner."""
    return F.regexp_replace(text, rf"(?sm)\A.*^(?:{mark})[^\n]*\n?", "")


def decision(line: Column) -> Column:
    """``3 d reason``, ``4 i wording``, ``5 k`` -> (k, action, rest); nulls if malformed."""
    rx = r"^\s*(\d+)\s+([dik])\b\s*(.*?)\s*\z"
    ok = F.regexp_like(line, F.lit(rx))
    return F.struct(F.when(ok, F.regexp_extract(line, rx, 1).cast("int")).alias("k"), F.when(ok, F.regexp_extract(line, rx, 2)).alias("action"), F.when(ok, F.regexp_extract(line, rx, 3)).alias("rest"))


def diagnostics(output: Column) -> Column:
    """``file(line,col): error TSnnnn: message`` lines of a checker -> array of (file, line, code, msg)."""
    rx = r"(?m)^(.+?)[:(](\d+)[:,](\d+)\)?\s*[-:]\s*error\s+(?:TS|ts\()?(\d+)\)?:\s*(.*)$"
    g = [F.regexp_extract_all(strip_ansi(output), F.lit(rx), F.lit(k)) for k in (1, 2, 4, 5)]
    return F.transform(F.arrays_zip(*[c.alias(n) for c, n in zip(g, ("file", "line", "code", "msg"))]), lambda x: F.struct(x["file"].alias("file"), x["line"].cast("int").alias("line"), x["code"].cast("int").alias("code"), F.left(x["msg"], F.lit(300)).alias("msg")))


def shingles(text: Column, width: int = 3) -> Column:
    """Distinct runs of ``width`` words over [a-z0-9:./@-]; none for fewer words."""
    words = F.split(F.trim(F.regexp_replace(F.lower(text), r"[^a-z0-9:./@-]+", " ")), " ")

    def runs(w: Column) -> Column:
        every = F.transform(F.sequence(F.lit(1), F.size(w) - width + 1), lambda i: F.array_join(F.slice(w, i, width), " "))
        return F.when(F.size(w) >= width, F.array_distinct(every)).otherwise(F.array().cast("array<string>"))

    return let(words, runs)


def query_words(text: Column) -> Column:
    return F.array_distinct(F.regexp_extract_all(F.lower(text), F.lit(r"[a-z0-9:._-]{4,}"), F.lit(0)))


def overlap(words: Column, text: Column) -> Column:
    """How many of the words a text contains."""
    return let(F.lower(text), lambda low: F.size(F.filter(words, lambda w: F.contains(low, w))))


def normalize_question(text: Column) -> Column:
    return F.trim(F.regexp_replace(F.lower(text), r"\s+", " "))


def word_count(text: Column) -> Column:
    return F.size(F.filter(F.split(text, r"\s+"), lambda w: w != ""))


def key_signature(json: Column) -> Column:
    return F.array_join(F.array_sort(F.json_object_keys(json)), ",")


def iso_time(at: Column) -> Column:
    """A time in UTC as ISO 8601 with milliseconds; the session's zone has to be UTC."""
    return F.date_format(at, "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'")


def option_list(value: Column) -> Column:
    """Entries of a comma-separated option, without white space around and empty ones."""
    return F.filter(F.transform(F.split(value, ","), lambda x: F.trim(x)), lambda x: x != "")


def rotate(items: Column, i: Column) -> Column:
    n = F.size(items)
    k = F.pmod(i, n)
    return F.concat(F.slice(items, k + 1, n), F.slice(items, F.lit(1), k))


def unit(v: Column) -> Column:
    """The vector over its length; a zero vector gives nulls, which are near nothing."""
    d = F.transform(v, lambda x: x.cast("double"))
    length = F.sqrt(F.aggregate(d, F.lit(0.0), lambda a, x: a + x * x))
    return let(length, lambda n: F.transform(d, lambda x: x / F.nullif(n, F.lit(0.0))))


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)
