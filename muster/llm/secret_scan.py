"""Secret scan: three fixed patterns, and a log-likelihood ratio of two character Markov models for what no pattern names.

All of it is DataFrame functions. A pattern's matches are enclosed in control characters, the text is split at them, and the
lengths of what lies between give code-point positions, in chunks of FOLD pieces, so that a text of very many matches takes little more
than its length. (Those control characters are first replaced in a text that holds
them; no pattern matches either of them.)

Long runs of identifier characters are candidates. Two first-order character models are trained from labelled samples: what
the patterns found, over all documents, is labelled random; identifiers of 8 or more characters that hold no match, from about
`sample` documents chosen by a hash of doc_id, are labelled ordinary. A candidate whose ratio is at least `least` nats and
which overlaps no pattern's match is a span of kind "random". Tables have one row per pair of alphabet characters. Both models count each
distinct token once, so copies of a text, however many, change no ratio.

Defined cases: null texts are empty and have no span. Repeated rows are reported each. A null doc_id is never in the ordinary sample.
Without any pattern match, every random pair is equally likely. Texts of any length are scanned whole. Extra columns are not
read; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from muster.llm.common import staged

#: The kinds in the order in which they are listed, and their patterns. Failing matches are dropped by `_passes`.
KINDS = ["assign", "access", "hex", "random"]
ASSIGN = r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"(?<![0-9a-f])[0-9a-f]{16,}"
ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_-"
CANDIDATE = r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{16,}"
ORDINARY = r"(?<![A-Za-z0-9+/_-])[A-Za-z_][A-Za-z0-9_]{7,}"
LEAST, SAMPLE = 8.0, 4_000
FOLD = 256
_EDGE, _INNER = "\x01", "\x03"
_SPAN = "struct<start:int,kind:int,end:int,value:string>"


def _spans(text: Column, may: Column, kind: str, pattern: str, value: str, passes) -> Column:
    """Array of the pattern's spans; `value` is the group that is kept with them and that `passes` looks at."""
    marked = F.regexp_replace(text, F.lit(pattern), F.lit(f"{_EDGE}$0{_INNER}{value}{_EDGE}"))
    pieces = F.when(may, F.split(marked, _EDGE, -1)).otherwise(F.array().cast("array<string>"))
    whole, kept = lambda x: F.substring_index(x, _INNER, 1), lambda x: F.substring_index(x, _INNER, -1)
    item = lambda x, i: F.struct(F.length(whole(x)).alias("n"), ((i % 2 == 1) & passes(kept(x), whole(x))).alias("match"), kept(x).alias("value"))

    def step(acc: Column, x: Column) -> Column:
        end = acc["at"] + x["n"]
        span = F.struct(acc["at"].alias("start"), F.lit(KINDS.index(kind)).alias("kind"), end.alias("end"), x["value"].alias("value"))
        return F.struct(end.alias("at"), F.when(x["match"], F.concat(acc["out"], F.array(span))).otherwise(acc["out"]).alias("out"))

    none = F.array().cast(f"array<{_SPAN}>")
    start = lambda at: F.struct(at.alias("at"), none.alias("out"))
    placed = lambda chunks, at: F.flatten(F.transform(chunks, lambda chunk, c: F.aggregate(chunk, start(F.get(at, c)), step, lambda acc: acc["out"])))
    return _let(F.transform(pieces, item), lambda items: _let(_chunks(items), lambda chunks: _let(_starts(chunks), lambda at: placed(chunks, at))))


def _let(value: Column, then) -> Column:
    """`then` of a value that is computed once, however often `then` names it."""
    return F.get(F.transform(F.array(value), then), F.lit(0))


def _chunks(items: Column) -> Column:
    """The items in arrays of FOLD. A fold copies its state at every step, so none here collects more than a chunk's spans."""
    return F.transform(F.sequence(F.lit(0), F.floor(F.size(items) / FOLD).cast("int")), lambda c: F.slice(items, c * FOLD + 1, F.lit(FOLD)))


def _starts(chunks: Column) -> Column:
    """How many code points lie before each chunk."""
    length = lambda chunk: F.aggregate(chunk, F.lit(0), lambda n, x: n + x["n"])
    first = F.struct(F.lit(0).alias("at"), F.array().cast("array<int>").alias("out"))
    step = lambda acc, chunk: F.struct((acc["at"] + length(chunk)).alias("at"), F.concat(acc["out"], F.array(acc["at"])).alias("out"))
    return F.aggregate(chunks, first, step, lambda acc: acc["out"])


def _apart(rows: DataFrame) -> DataFrame:
    """(row, m): the spans of `maybe`, which do not overlap one another, that overlap none of `base`. A text's spans meet in its order, in
    which the furthest end of a base span before and the nearest start of one behind decide."""
    alone = rows.where(F.size("base") == 0).select("row", F.explode("maybe").alias("m"))
    mixed = rows.where((F.size("base") > 0) & (F.size("maybe") > 0)).select("row", F.explode(F.concat("base", "maybe")).alias("m"))
    named, text = F.col("m.kind") < len(KINDS) - 1, Window.partitionBy("row")
    before = text.orderBy("m.start", "m.kind").rowsBetween(Window.unboundedPreceding, -1)
    behind = text.orderBy(F.desc("m.start"), F.desc("m.kind")).rowsBetween(Window.unboundedPreceding, -1)
    seen = mixed.withColumns({"named": named, "reach": F.max(F.when(named, F.col("m.end"))).over(before), "next": F.min(F.when(named, F.col("m.start"))).over(behind)})
    free = ~F.col("named") & (F.coalesce("reach", F.lit(0)) <= F.col("m.start")) & (F.col("next").isNull() | (F.col("next") >= F.col("m.end")))
    return alone.union(seen.where(free).select("row", "m"))


def base_spans(text: Column) -> Column:
    """Array of (start, kind, end, value) of the three patterns, by start, then kind."""
    any_of = lambda *marks: F.greatest(*[F.contains(text, F.lit(m)) for m in marks]) if len(marks) > 1 else F.contains(text, F.lit(marks[0]))
    return F.array_sort(F.concat(
        _spans(text, any_of("=", ":"), "assign", ASSIGN, "$2", lambda v, _: F.length(v) >= 12),
        _spans(text, any_of("AKIA"), "access", ACCESS, "$0", lambda v, _: F.length(v) >= 18),
        _spans(text, F.lit(True), "hex", HEX, "$0", lambda v, _: F.lit(True)),
    ))


def _pairs(token: Column) -> Column:
    """A row for each two neighbouring characters; the last character alone comes too, and equals no pair."""
    return F.explode(F.split(F.regexp_replace(token, F.lit("(?s)(.)(?=(.))"), F.lit(f"$1$2{_EDGE}")), _EDGE))


def ratios(random: DataFrame, ordinary: DataFrame) -> DataFrame:
    """(pair, ratio) for all pairs of alphabet characters, from the distinct tokens of both classes; counts start from one."""
    n = len(ALPHABET)
    letters = F.split(F.lit(ALPHABET), "")
    every = random.sparkSession.range(n * n).select(
        F.element_at(letters, (F.floor(F.col("id") / n) + 1).cast("int")).alias("one"), F.element_at(letters, (F.col("id") % n + 1).cast("int")).alias("two")
    ).withColumn("pair", F.concat("one", "two"))
    for name, tokens in (("r", random), ("o", ordinary)):
        counted = tokens.where(F.length("token") >= 2).select(_pairs(F.col("token")).alias("pair")).groupBy("pair").agg(F.count(F.lit(1)).alias(name))
        every = every.join(counted, "pair", "left")
    of_one = Window.partitionBy("one")
    chance = lambda c: (F.coalesce(F.col(c), F.lit(0)) + 1.0) / (F.coalesce(F.sum(c).over(of_one), F.lit(0)) + float(n))
    return every.select("pair", F.log(chance("r") / chance("o")).alias("ratio"))


def scanned(docs: DataFrame, least: float = LEAST, sample: int = SAMPLE) -> DataFrame:
    """(doc_id, base, added) per row: arrays of spans (start, kind, end, value); kind numbers KINDS."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    safe = F.when(F.contains(text, F.lit(_EDGE)) | F.contains(text, F.lit(_INNER)), F.translate(text, _EDGE + _INNER, "\x02\x02")).otherwise(text)
    plain = docs.select(F.col("doc_id").cast("long").alias("doc_id"), safe.alias("safe"))
    rows = staged(
        plain.select("doc_id", base_spans(F.col("safe")).alias("base"), _spans(F.col("safe"), F.lit(True), "random", CANDIDATE, "$0", lambda v, _: F.lit(True)).alias("maybe"))
        .withColumn("row", F.monotonically_increasing_id()),
        "spans",
    )
    share = int(1_000_000 * min(1.0, sample / max(1, rows.count())))
    few = plain.where(F.pmod(F.xxhash64("doc_id", F.lit(5)), F.lit(1_000_000)) < share)
    clean = few.where(F.col("doc_id").isNotNull()).join(rows.where(F.size("base") > 0).select("doc_id").distinct(), "doc_id", "left_anti")
    tokens = clean.select(F.explode(F.regexp_extract_all("safe", F.lit(ORDINARY), F.lit(0))).alias("token")).distinct()
    random = rows.select(F.explode("base.value").alias("token")).distinct()
    table = staged(ratios(random, tokens), "ratios")

    left = _apart(rows)
    names = left.select(F.col("m.value").alias("token")).distinct()
    summed = names.select("token", _pairs(F.col("token")).alias("pair")).join(table, "pair").groupBy("token").agg(F.sum("ratio").alias("ratio")).where(F.col("ratio") >= least)
    found = left.withColumn("token", F.col("m.value")).join(summed, "token").groupBy("row").agg(F.array_sort(F.collect_list("m")).alias("added"))
    empty = F.array().cast(f"array<{_SPAN}>")
    return rows.join(found, "row", "left").select("doc_id", "base", F.coalesce("added", empty).alias("added"))


def listed(spans: Column) -> Column:
    """kind:start:end of each span by start, then kind, comma-joined."""
    name = lambda s: F.element_at(F.array(*[F.lit(k) for k in KINDS]), s["kind"] + 1)
    return F.array_join(F.transform(F.array_sort(spans), lambda s: F.concat_ws(":", name(s), s["start"].cast("string"), s["end"].cast("string"))), ",")
