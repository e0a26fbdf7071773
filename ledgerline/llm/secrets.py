"""Secret scan with a randomness battery (operator 1).

Base spans come from three fixed patterns. Besides them, every token of
``MIN_CHARS`` or more characters out of letters, digits, ``+/_-`` that has a
letter and a digit is a candidate. Its encoding is inferred (the smallest of
hex, base32, base36, base62, base64 and its URL form that holds it), its
characters become digits of that encoding, and three tests ask whether they
could be drawn at random:

* chi-squared: are all digits equally frequent (Wilson-Hilferty, with the
  exact variance of short samples),
* runs: do lower and upper halves of the alphabet alternate as often as chance
  has it (Wald-Wolfowitz),
* serial correlation of neighbouring digits at lag one.

The token's p-value is three times the smallest of theirs. Within each band of
lengths the false-discovery procedure of Benjamini and Hochberg at ``Q``
rejects tokens as written by hand; what it leaves, with ``MIN_BITS`` of nominal
randomness at least, is a secret. Bands keep many short tokens, on which the
tests have little power, from setting the limit for long ones. The procedure
needs p-values by rank over all documents: counts per band and 1/100 of a
decade of p (a table of bounded size) give them without sorting anything.

A token without a digit, or without a letter, is never a candidate: words and
numbers would otherwise be most of them. Of random tokens that loses those with
no digit by chance: in base 62, 3 percent at 20 characters, 0.4 at 32, 0.1 at 40.

Positions are code points, end exclusive. A null or empty text has no spans.
Rows that repeat a document get equal rows; an empty table gives none. Only
DataFrame functions are used; texts are never shuffled.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerline.llm.common import Scratch

# The base patterns. Runs of 24+ hex digits and of AKIA with 16+
# more are the runs the contract keeps; shorter ones overlap no longer one.
ASSIGN = r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{16,}"
HEX = r"[0-9a-f]{24,}"
VALUE_CHARS = 6
MIN_CHARS, MIN_BITS, Q = 20, 80, 0.05
CANDIDATE = r"[A-Za-z0-9+/_-]{%d,}+={0,2}" % MIN_CHARS
PATTERNS = {"assign": ASSIGN, "access": ACCESS, "hex": HEX, "random": CANDIDATE}
KINDS = tuple(PATTERNS)
LENGTH_BANDS = (28, 40, 64, 128)
_DIGITS, _LOW, _UP = "0123456789", "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
ENCODINGS = (
    (r"^[0-9a-f]+$", _DIGITS + _LOW[:6]), (r"^[0-9A-F]+$", _DIGITS + _UP[:6]), (r"^[A-Z2-7]+$", _UP + "234567"),
    (r"^[0-9a-z]+$", _DIGITS + _LOW), (r"^[0-9A-Z]+$", _DIGITS + _UP), (r"^[0-9A-Za-z]+$", _DIGITS + _UP + _LOW),
    (r"^[0-9A-Za-z+/]+$", _UP + _LOW + _DIGITS + "+/"), (r"^[0-9A-Za-z_-]+$", _UP + _LOW + _DIGITS + "-_"),
)


def _tail(z: Column) -> Column:
    """Upper tail of the normal distribution (a rational approximation with an
    error below 1e-7, floored there so that logarithms exist)."""
    x = F.abs(z)
    t = 1 / (1 + 0.2316419 * x)
    poly = t * (0.319381530 + t * (-0.356563782 + t * (1.781477937 + t * (-1.821255978 + t * 1.330274429))))
    tail = F.exp(-x * x / 2) / 2.5066282746 * poly
    return F.greatest(F.when(z >= 0, tail).otherwise(1 - tail), F.lit(1e-40))


def matches(df: DataFrame) -> DataFrame:
    """Rows ``doc_id, text_hash, kind, start, stop, found`` of all matches of
    all patterns, from one reading of the texts.

    A text is split at a pattern; a match starts after all pieces and matches
    before it. Sums run over one document's matches only.
    """
    found = {kind: F.regexp_extract_all("text", F.lit(pattern), F.lit(0)) for kind, pattern in PATTERNS.items()}
    some = df.where(F.greatest(*[F.size(x) for x in found.values()]) > 0)
    each = [
        F.when(F.size(found[kind]) > 0, F.struct(F.lit(kind).alias("kind"), F.arrays_zip(found[kind].alias("found"), F.split("text", pattern).alias("gap")).alias("cuts")))
        for kind, pattern in PATTERNS.items()
    ]
    rows = some.select("doc_id", "text_hash", F.explode(F.array_compact(F.array(*each))).alias("own"))
    rows = rows.select("doc_id", "text_hash", F.col("own.kind").alias("kind"), F.posexplode("own.cuts").alias("nth", "cut")).where("cut.found is not null")
    rows = rows.groupBy("doc_id", "text_hash", "kind", "nth").agg(F.first("cut.found").alias("found"), F.first(F.length("cut.gap")).alias("gap"))
    upto = Window.partitionBy("doc_id", "text_hash", "kind").orderBy("nth").rowsBetween(Window.unboundedPreceding, 0)
    stop = F.sum(F.col("gap") + F.length("found")).over(upto)
    rows = rows.select("doc_id", "text_hash", "kind", stop.alias("stop"), "found")
    return rows.select("doc_id", "text_hash", "kind", (F.col("stop") - F.length("found")).alias("start"), "stop", "found")


def battery(tokens: DataFrame, column: str = "found") -> DataFrame:
    """``tokens`` with ``alphabet`` (null: no encoding), ``n`` and the p-value
    ``p`` of the three tests."""
    body = F.rtrim(F.col(column), F.lit("="))
    mixed = body.rlike("[0-9]") & body.rlike("[A-Za-z]")
    alphabet = F.lit(None).cast("string")
    for pattern, letters in reversed(ENCODINGS):
        alphabet = F.when(body.rlike(pattern), F.lit(letters)).otherwise(alphabet)
    df = tokens.withColumn("body", body).withColumn("alphabet", F.when(mixed, alphabet))
    df = df.withColumn("n", F.length("body").cast("double")).withColumn("a", F.length("alphabet").cast("double"))
    df = df.withColumn("digits", F.expr("transform(sequence(1, length(body)), i -> locate(substr(body, i, 1), alphabet) - 1)"))
    df = df.withColumn("squares", F.expr("aggregate(transform(sequence(1, length(alphabet)), k -> length(body) - length(replace(body, substr(alphabet, k, 1), ''))), 0D, (s, c) -> s + double(c) * c)"))
    df = df.withColumn("mean", F.expr("aggregate(digits, 0D, (s, d) -> s + d) / n"))
    df = df.withColumn("spread", F.expr("aggregate(digits, 0D, (s, d) -> s + (d - mean) * (d - mean))"))
    df = df.withColumn("lagged", F.expr("aggregate(sequence(1, int(n) - 1), 0D, (s, i) -> s + (digits[i] - mean) * (digits[i - 1] - mean))"))
    df = df.withColumn("high", F.expr("aggregate(digits, 0D, (s, d) -> s + if(2 * d >= a, 1, 0))"))
    df = df.withColumn("runs", F.expr("aggregate(sequence(1, int(n) - 1), 1D, (s, i) -> s + if((2 * digits[i] >= a) <> (2 * digits[i - 1] >= a), 1, 0))"))

    n, a, df_chi = F.col("n"), F.col("a"), F.col("a") - 1
    chi = a / n * F.col("squares") - n
    # Rescaled to the variance of a chi-squared variate before the cube root.
    chi = F.greatest(df_chi + (chi - df_chi) / F.sqrt((n - 1) / n), F.lit(0.0))
    z_chi = (F.pow(chi / df_chi, F.lit(1 / 3)) - (1 - 2 / (9 * df_chi))) / F.sqrt(2 / (9 * df_chi))
    high, low = F.col("high"), F.col("n") - F.col("high")
    mean_runs = 1 + 2 * high * low / n
    var_runs = 2 * high * low * (2 * high * low - n) / (n * n * (n - 1))
    z_runs = F.when(var_runs > 0, F.abs(F.col("runs") - mean_runs) / F.sqrt(var_runs)).otherwise(F.lit(6.0))
    z_serial = F.when(F.col("spread") > 0, F.abs(F.col("lagged") / F.col("spread") + 1 / n) * F.sqrt(n)).otherwise(F.lit(6.0))
    p = F.least(F.lit(1.0), 3 * F.least(_tail(z_chi), 2 * _tail(z_runs), 2 * _tail(z_serial)))
    bits = n * F.log2(a)
    return df.withColumn("p", p).withColumn("bits", bits).drop("body", "digits", "squares", "mean", "spread", "lagged", "high", "runs")


def _band() -> Column:
    out = F.lit(len(LENGTH_BANDS))
    for k, limit in reversed(list(enumerate(LENGTH_BANDS))):
        out = F.when(F.col("n") < limit, k).otherwise(out)
    return out


def control(tested: DataFrame, q: float = Q) -> DataFrame:
    """Tokens that the false-discovery procedure leaves as random.

    ``step`` is the p-value in hundredths of a decade. The limit of a band is
    the least step whose p-value is within ``q`` times the share of the band's
    tokens at that step or beyond."""
    tested = tested.withColumn("band", _band()).withColumn("step", F.floor(-100 * F.log10("p")).cast("int"))
    counts = tested.groupBy("band", "step").agg(F.count("*").alias("tokens"))
    beyond = Window.partitionBy("band").orderBy(F.desc("step"))
    share = F.sum("tokens").over(beyond) / F.sum("tokens").over(Window.partitionBy("band"))
    limits = counts.select("band", "step", share.alias("share")).where(F.pow(F.lit(10.0), -F.col("step") / 100) <= q * F.col("share"))
    limits = limits.groupBy("band").agg(F.min("step").alias("limit"))
    left = tested.join(F.broadcast(limits), "band", "left").where(F.col("limit").isNull() | (F.col("step") < F.col("limit")))
    return left.where(F.col("bits") >= MIN_BITS)


def keyed(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("text_hash"), F.coalesce(F.col("text"), F.lit("")).alias("text"))


def find_secrets(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """All spans: ``doc_id, text_hash, kind, start, stop, found``."""
    scratch = Scratch(spark, "secrets")
    found = scratch.keep(matches(keyed(docs)), "found")
    value = F.length(F.regexp_extract("found", ASSIGN, 2))
    base = found.where(F.col("kind") != "random").where((F.col("kind") != "assign") | (value >= VALUE_CHARS))
    tested = battery(found.where(F.col("kind") == "random")).where("alphabet is not null")
    tested = scratch.keep(tested.select("doc_id", "text_hash", "kind", "start", "stop", "found", "n", "bits", "p"), "tested")
    return base.unionByName(control(tested).select("doc_id", "text_hash", "kind", "start", "stop", "found"))


def _listed(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.element_at(F.array(*map(F.lit, KINDS)), s["order"]), s["start"].cast("string"), s["stop"].cast("string"))), ",")


def scan_secrets(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """One row per document: ``spans`` as structs (start, order of the kind,
    stop), the counts of each kind and both texts of the spans."""
    order = F.array_position(F.array(*map(F.lit, KINDS)), F.col("kind")).cast("int")
    spans = find_secrets(spark, docs).select("doc_id", "text_hash", "start", order.alias("order"), "stop")
    per_doc = spans.groupBy("doc_id", "text_hash").agg(
        *[F.count(F.when(F.col("order") == k + 1, 1)).alias(f"n_{kind}") for k, kind in enumerate(KINDS)],
        F.sort_array(F.collect_list(F.struct("start", "order", "stop"))).alias("secret_spans"),
    )
    ids = keyed(docs).select("doc_id", "text_hash")
    same = ids["doc_id"].eqNullSafe(per_doc["doc_id"]) & (ids["text_hash"] == per_doc["text_hash"])
    rows = ids.join(per_doc, same, "left").select(
        ids["doc_id"], ids["text_hash"], *[F.coalesce(f"n_{kind}", F.lit(0)).cast("long").alias(f"n_{kind}") for kind in KINDS],
        F.coalesce("secret_spans", F.array().cast("array<struct<start:bigint,order:int,stop:bigint>>")).alias("secret_spans"),
    )
    base = _listed(F.filter("secret_spans", lambda s: s["order"] < len(KINDS)))
    return rows.select("*", F.sha2(base, 256).alias("base_sha256"), _listed(F.col("secret_spans")).alias("spans"))


def redact(spark: SparkSession, docs: DataFrame, mask: str = "[SECRET]") -> DataFrame:
    """``docs`` with every span of a secret replaced by ``mask`` (overlapping
    spans as one); documents without any are unchanged. ``n_chars``, if there,
    follows the text; all other columns stay, whatever their names."""
    spans = find_secrets(spark, docs).groupBy("doc_id", "text_hash", "start").agg(F.max("stop").alias("stop"))
    so_far = Window.partitionBy("doc_id", "text_hash").orderBy("start")
    reach = F.max("stop").over(so_far.rowsBetween(Window.unboundedPreceding, -1))
    spans = spans.withColumn("new", F.when(reach.isNull() | (F.col("start") > reach), 1).otherwise(0)).withColumn("island", F.sum("new").over(so_far))
    islands = spans.groupBy("doc_id", "text_hash", "island").agg(F.min("start").alias("start"), F.max("stop").alias("stop"))
    per_doc = islands.groupBy("doc_id", "text_hash").agg(F.sort_array(F.collect_list(F.struct("start", "stop"))).alias("cuts"))
    same = docs["doc_id"].cast("long").eqNullSafe(per_doc["doc_id"]) & (F.xxhash64(docs["text"]) == per_doc["text_hash"])
    joined, cuts = docs.join(per_doc, same, "left"), per_doc["cuts"]

    def between(cut: Column, k: Column) -> Column:
        begin = F.when(k == 0, F.lit(0)).otherwise(F.get(cuts, k - 1)["stop"])
        return F.substring(docs["text"], (begin + 1).cast("int"), (cut["start"] - begin).cast("int"))

    tail = F.substring(docs["text"], (F.element_at(cuts, -1)["stop"] + 1).cast("int"), F.length(docs["text"]))
    clean = F.concat(F.array_join(F.transform(cuts, between), mask), F.lit(mask), tail)
    text = F.when(cuts.isNull(), docs["text"]).otherwise(clean)
    columns = []
    for name in docs.columns:
        if name == "text":
            columns.append(text.alias("text"))
        elif name == "n_chars":
            columns.append(F.when(cuts.isNull(), docs["n_chars"]).otherwise(F.length(text)).cast(docs.schema["n_chars"].dataType).alias("n_chars"))
        else:
            columns.append(docs[name])
    return joined.select(*columns)
