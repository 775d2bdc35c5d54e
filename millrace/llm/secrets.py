"""Secret scan: patterns, and a battery of randomness tests on what they miss.

Everything is a DataFrame expression.  Texts are cut at the matches of a
pattern, and the lengths of the pieces give the spans.  Long tokens that no
pattern covers are tested for randomness: a chi-squared test that the symbols of
the inferred encoding are equally frequent, a runs test around the middle of the
alphabet, and a test of correlation between neighbouring symbols.  A weighted
step-up procedure over all tokens of the corpus rejects those that are not
random, with weights by length, since short tokens say little; what is not
rejected and long enough is reported.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, functions as F

from millrace.sources.storage import materialize

# The base patterns; what a match needs besides is in `base_spans`.
ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{16,}"  # 20 characters or more in all
HEX = r"[0-9a-f]{24,}"  # whole runs, as the quantifier is greedy
KINDS = ("assign", "access", "hex", "random")
MIN_VALUE = 6

# 20 characters or more; '=' only as padding, so the value of NAME=value is a token of its own.
_C = "A-Za-z0-9+/_-"
TOKEN = rf"(?<![{_C}])(?:[{_C}]{{20,}}+(?:=++(?![{_C}]))?|[{_C}]{{19}}=++(?![{_C}])|[{_C}]{{18}}==++(?![{_C}]))"
# Encodings from the narrowest: pattern, and the alphabet in order.
ENCODINGS = [
    (r"^[0-9]+$", "0123456789"),
    (r"^[0-9a-f]+$", "0123456789abcdef"),
    (r"^[0-9A-F]+$", "0123456789ABCDEF"),
    (r"^[a-z]+$", "abcdefghijklmnopqrstuvwxyz"),
    (r"^[A-Z]+$", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"),
    (r"^[A-Z2-7]+=*$", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"),
    (r"^[0-9a-z]+$", "0123456789abcdefghijklmnopqrstuvwxyz"),
    (r"^[0-9A-Z]+$", "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZ"),
    (r"^[0-9A-Za-z]+$", "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"),
    (r"^[0-9A-Za-z+/]+=*$", "+/0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"),
    (r"^[0-9A-Za-z_-]+=*$", "-0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZ_abcdefghijklmnopqrstuvwxyz"),
]
FALSE_DISCOVERY = 0.05
MIN_BITS = 80  # of a random token; shorter ones are not reported
WORD_BITS = 200  # of one in letters of a single case, which may as well be words
BINS_PER_DECADE = 8  # of the p-values that the step-up procedure counts
LEAST_LOG = -30  # p-values below 10^-30 count as that


def _running(steps: Column) -> Column:
    """Running sums of an array of at least two numbers, by adding what lies 1, 2, 4, ... places before."""
    rounds = F.sequence(F.lit(0), F.ceil(F.log2(F.size(steps))).cast("int") - 1)

    def add(sums: Column, i: Column) -> Column:
        shift = F.call_function("shiftleft", F.lit(1), i)
        moved = F.concat(F.array_repeat(F.lit(0), shift), F.slice(sums, F.lit(1), F.size(sums) - shift))
        return F.zip_with(sums, moved, lambda a, b: a + b)

    return F.aggregate(rounds, steps, add)


def _untouched(tokens: Column, spans: Column) -> Column:
    """The tokens, in order and apart, that no span overlaps.

    In the merged order of starts (or ends) of both, a token's place less its
    number is how many spans start before its end (or end by its start); a span
    overlaps it if the first is more.
    """

    def places(own: str, other: str, first: int) -> Column:
        mine = F.transform(tokens, lambda t: F.struct(t[own].alias("at"), F.lit(first).alias("side")))
        theirs = F.transform(spans, lambda s: F.struct(s[other].alias("at"), F.lit(1 - first).alias("side")))
        merged = F.sort_array(F.concat(mine, theirs))
        placed = F.transform(merged, lambda m, i: F.when(m["side"] == first, i))
        return F.filter(placed, lambda i: i.isNotNull())

    touched = F.zip_with(places("end", "start", 0), places("start", "end", 1), lambda started, ended: started > ended)
    marked = F.zip_with(tokens, touched, lambda t, over: F.struct(t.alias("token"), over.alias("over")))
    free = F.transform(F.filter(marked, lambda m: ~m["over"]), lambda m: m["token"])
    return F.when((F.size(tokens) > 0) & (F.size(spans) > 0), free).otherwise(tokens)


def _spans(text: Column, pattern: str, keep=None) -> Column:
    """Array of (start, end, text) of the leftmost non-overlapping matches, in code points."""
    hits = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    values = F.regexp_extract_all(text, F.lit(pattern), F.lit(2)) if keep else hits
    gaps = F.transform(F.split(text, pattern, -1), F.length)
    steps = F.zip_with(hits, gaps, lambda h, g: F.coalesce(F.length(h), F.lit(0)) + g)
    found = F.zip_with(hits, values, lambda h, v: F.struct(h.alias("hit"), v.alias("value")))
    # the last gap has no match
    walked = F.filter(
        F.zip_with(
            found,
            _running(steps),
            lambda p, end: F.struct(
                (end - F.length(p["hit"])).alias("start"), end.alias("end"), p["hit"].alias("hit"), p["value"].alias("value")
            ),
        ),
        lambda s: s["hit"].isNotNull(),
    )
    empty = F.expr("cast(array() as array<struct<start:int,end:int,hit:string,value:string>>)")
    spans = F.when(F.size(hits) > 0, walked).otherwise(empty)
    return F.filter(spans, keep) if keep else spans


def _tail(z: Column) -> Column:
    """Upper tail of the normal distribution (polynomial of Abramowitz and Stegun, 26.2.17)."""
    x = F.least(F.abs(z), F.lit(37.0))
    t = 1 / (1 + 0.2316419 * x)
    poly = t * (0.319381530 + t * (-0.356563782 + t * (1.781477937 + t * (-1.821255978 + t * 1.330274429))))
    upper = F.exp(-x * x / 2) / math.sqrt(2 * math.pi) * poly
    return F.when(z >= 0, upper).otherwise(1 - upper)


def _with_tests(tokens: DataFrame) -> DataFrame:
    """`p` (that the token is random) and `bits`, for rows with a `token`."""
    bare = F.regexp_replace("token", "=+$", "")
    alphabet = F.lit(None).cast("string")
    for pattern, letters in reversed(ENCODINGS):
        alphabet = F.when(F.col("token").rlike(pattern), F.lit(letters)).otherwise(alphabet)
    # a mix of both base64 styles is no encoding; it is measured on all printed characters
    wide = "+-/0123456789=ABCDEFGHIJKLMNOPQRSTUVWXYZ_abcdefghijklmnopqrstuvwxyz"
    rows = tokens.withColumns({"alphabet": F.coalesce(alphabet, F.lit(wide)), "bare": F.when(alphabet.isNull(), F.col("token")).otherwise(bare)})
    rows = rows.withColumns(
        {
            "codes": F.expr("transform(filter(split(bare, ''), c -> c != ''), c -> locate(c, alphabet))"),
            "width": F.length("alphabet").cast("double"),
        }
    ).withColumn("n", F.size("codes").cast("double"))
    square = F.expr("aggregate(transform(array_distinct(codes), d -> size(filter(codes, c -> c = d))), 0D, (s, k) -> s + double(k) * k)")
    chi = square * F.col("width") / F.col("n") - F.col("n")
    free = F.col("width") - 1
    rows = rows.withColumn("z_chi", (chi - free) / F.sqrt(2 * free * (F.col("n") - 1) / F.col("n")))
    rows = rows.withColumn("sides", F.expr("transform(codes, c -> c > width / 2)"))
    rows = rows.withColumns(
        {
            "high": F.expr("double(size(filter(sides, s -> s)))"),
            "runs": F.expr("1D + size(filter(zip_with(slice(sides, 2, size(sides)), slice(sides, 1, size(sides) - 1), (a, b) -> a != b), x -> x))"),
            "mean": F.expr("aggregate(codes, 0D, (s, c) -> s + c) / n"),
        }
    )
    low = F.col("n") - F.col("high")
    cross = 2 * F.col("high") * low
    expected = cross / F.col("n") + 1
    spread = cross * (cross - F.col("n")) / (F.col("n") * F.col("n") * (F.col("n") - 1))
    rows = rows.withColumn("z_runs", F.when(spread > 0, (F.col("runs") - expected) / F.sqrt(spread)).otherwise(8.0))
    around = F.expr("aggregate(codes, 0D, (s, c) -> s + (c - mean) * (c - mean))")
    lagged = F.expr("aggregate(zip_with(slice(codes, 2, size(codes)), slice(codes, 1, size(codes) - 1), (a, b) -> (a - mean) * (b - mean)), 0D, (s, x) -> s + x)")
    rows = rows.withColumn("z_serial", F.when(around > 0, (lagged / around + 1 / F.col("n")) * F.sqrt("n")).otherwise(8.0))
    least = F.least(_tail(F.col("z_chi")), 2 * _tail(F.abs("z_runs")), 2 * _tail(F.abs("z_serial")))
    return rows.withColumns({"p": F.least(F.lit(1.0), 3 * least), "bits": F.col("n") * F.log2("width")})


def _tested(hits: Column) -> Column:
    """Placeholder for the array form of the tokens, without their tests."""
    return F.transform(hits, lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), s["hit"].alias("token")))


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """`row`, `doc_id`, `base` and `tokens`: spans per row of `docs`, written to the shared folder.

    `base` holds (start, kind, end), `tokens` the (start, end, token) that no base
    span touches.  `row` numbers the rows of this table.
    """
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), text.alias("text"))
    kind = lambda spans, k: F.transform(spans, lambda s: F.struct(s["start"].alias("start"), F.lit(k).alias("kind"), s["end"].alias("end")))
    base = F.array_sort(
        F.concat(
            kind(_spans(F.col("text"), ASSIGN, lambda s: F.length(s["value"]) >= MIN_VALUE), 0),
            kind(_spans(F.col("text"), ACCESS), 1),
            kind(_spans(F.col("text"), HEX), 2),
        )
    )
    found = rows.select("doc_id", base.alias("base"), _tested(_spans(F.col("text"), TOKEN)).alias("tokens"))
    return materialize(found.withColumn("tokens", _untouched(F.col("tokens"), F.col("base"))).withColumn("row", F.monotonically_increasing_id()), "spans")


def threshold(tested: DataFrame) -> tuple[float, float]:
    """Largest rejected value of p over weight, and the mean bits that weights refer to.

    The step-up procedure on binned p-values: bins are rounded up, so at most
    the stated share of the rejected tokens is random.  Bounded: a row per bin.
    """
    mean = tested.agg(F.avg("bits")).first()[0]
    if not mean:
        return -1.0, 1.0
    value = F.greatest(F.log10(F.greatest(F.col("p") * mean / F.col("bits"), F.lit(1e-300))), F.lit(float(LEAST_LOG)))
    bins = tested.groupBy(F.ceil(value * BINS_PER_DECADE).alias("bin")).count().collect()
    total, below, limit = sum(b["count"] for b in bins), 0, -1.0
    for b in sorted(bins, key=lambda b: b["bin"]):
        below += b["count"]
        if 10 ** (b["bin"] / BINS_PER_DECADE) <= FALSE_DISCOVERY * below / total:
            limit = 10 ** (b["bin"] / BINS_PER_DECADE)
    return limit, mean


def find_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """`doc_id`, `base`, `found` per row of `docs`: arrays of (start, kind, end) in code points.

    `base` are the spans of the patterns, `found` those and the random tokens.
    Kinds are numbers in `KINDS`.  Null and empty texts have none.  Repeated rows
    and null ids are rows like others.  Other columns are not read.  Very long
    texts take time by n log n in their n matches.
    """
    spans = scan(docs, id_col, text_col)
    tokens = spans.where(F.size("tokens") > 0).select("row", F.explode("tokens").alias("t"))
    wordy = F.col("token").rlike("^([a-z]+|[A-Z]+)$").alias("wordy")
    tested = _with_tests(tokens.select("row", "t.start", "t.end", "t.token")).select("row", "start", "end", "p", "bits", wordy)
    tested = materialize(tested, "tokens")
    limit, mean = threshold(tested)
    weighted = F.col("p") * mean / F.col("bits")
    kept = tested.where((weighted > limit) & (F.col("bits") >= F.when(F.col("wordy"), WORD_BITS).otherwise(MIN_BITS)))
    per_row = kept.groupBy("row").agg(F.collect_list(F.struct("start", F.lit(3).alias("kind"), "end")).alias("more"))
    joined = spans.join(per_row, "row", "left")
    both = F.when(F.col("more").isNull(), F.col("base")).otherwise(F.array_sort(F.concat("base", "more")))
    return joined.select("doc_id", "base", both.alias("found"))


def spelled(spans: str) -> Column:
    """kind:start:end of each span, joined by commas."""
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ",")
