"""Secret scan: fixed patterns plus a randomness test battery (DataFrame functions only).

Besides the base patterns, every run of 20 or more key characters is a
candidate. Its encoding is inferred (the smallest alphabet that holds it), and
three tests ask whether it can be a uniform draw from that alphabet:
chi-squared uniformity, Wald-Wolfowitz runs about the alphabet's middle, and
lag-1 serial correlation. Fisher's method joins the three p-values. Within each
length class Benjamini-Hochberg at ``FDR`` rejects the candidates that are not
random (words, paths, repeated marks); what is left is reported as ``random``.
The thresholds come from a histogram of log p, so nothing is ranked globally.

Defined results: null text counts as empty; a text without finds gives zero
counts, the hash of the empty string and an empty ``spans``. Offsets are code
points, end exclusive. Rows are independent: null and repeated ids are fine.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from docflow.llm.common import docs_of, query, written

KINDS = ("assign", "access", "hex", "random")
ASSIGN = r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]{24,}"  # the runs of [0-9a-f]+ that are long enough
RUN = r"[A-Za-z0-9+/_=-]{20,}"
FDR = 0.05
_BINS = 10  # bins per factor of ten in p
_LOWER, _DIGITS = "abcdefghijklmnopqrstuvwxyz", "0123456789"
# (pattern, alphabet), tried in this order
_ENCODINGS = [
    (r"^[0-9]+$", _DIGITS),
    (r"^[0-9a-f]+$", _DIGITS + "abcdef"),
    (r"^[0-9A-F]+$", _DIGITS + "ABCDEF"),
    (r"^[a-z]+$", _LOWER),
    (r"^[A-Z]+$", _LOWER.upper()),
    (r"^[A-Z2-7]+=*$", _LOWER.upper() + "234567"),
    (r"^[a-z0-9]+$", _LOWER + _DIGITS),
    (r"^[A-Z0-9]+$", _LOWER.upper() + _DIGITS),
    (r"^[A-Za-z0-9]+$", _LOWER.upper() + _LOWER + _DIGITS),
    (r"^[A-Za-z0-9+/]+=*$", _LOWER.upper() + _LOWER + _DIGITS + "+/"),
    (r"^[A-Za-z0-9_-]+=*$", _LOWER.upper() + _LOWER + _DIGITS + "-_"),
]
_ANY = _LOWER.upper() + _LOWER + _DIGITS + "+/-_="


def matches(text: Column, pattern: str, kind: int, least: int = 0, group: int = 0) -> Column:
    """array<struct<start, kind, end, value>> of the leftmost non-overlapping
    matches; matches whose ``group`` is shorter than ``least`` are dropped."""
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    parts = F.arrays_zip(
        F.split(text, pattern, -1).alias("before"),
        found.alias("hit"),
        F.regexp_extract_all(text, F.lit(pattern), F.lit(group)).alias("part"),
    )
    none = F.array().cast("array<struct<start:int,kind:int,end:int,value:string>>")

    def add(acc: Column, x: Column) -> Column:
        start = acc["at"] + F.length(x["before"])
        end = start + F.coalesce(F.length(x["hit"]), F.lit(0))
        one = F.struct(start.alias("start"), F.lit(kind).alias("kind"), end.alias("end"), x["part"].alias("value"))
        keep = x["hit"].isNotNull() & (F.length(x["part"]) >= least)
        return F.struct(end.alias("at"), F.when(keep, F.array_append(acc["out"], one)).otherwise(acc["out"]).alias("out"))

    walked = F.aggregate(parts, F.struct(F.lit(0).alias("at"), none.alias("out")), add, lambda acc: acc["out"])
    return F.when(text.rlike(pattern), walked).otherwise(none)


def _upper_tail(z: Column) -> Column:
    """P(Z > z) of a standard normal (rational approximation of erfc, 1.5e-7)."""
    x = F.abs(z) / F.sqrt(F.lit(2.0))
    t = 1 / (1 + 0.3275911 * x)
    poly = t * (0.254829592 + t * (-0.284496736 + t * (1.421413741 + t * (-1.453152027 + t * 1.061405429))))
    tail = 0.5 * poly * F.exp(-x * x)
    return F.greatest(F.when(z >= 0, tail).otherwise(1 - tail), F.lit(1e-300))


def randomness_p(value: Column) -> Column:
    """Fisher-combined p-value of the battery under "uniform draw of its alphabet"."""
    alphabet = F.lit(_ANY)
    for pattern, letters in reversed(_ENCODINGS):
        alphabet = F.when(value.rlike(pattern), F.lit(letters)).otherwise(alphabet)
    body = F.when(alphabet.contains("="), value).otherwise(F.regexp_replace(value, "=+$", ""))

    def of(x: Column) -> Column:
        n, k = F.length(x["body"]).cast("double"), F.length(x["alphabet"]).cast("double")
        squares = F.aggregate(
            F.split(x["alphabet"], ""), F.lit(0.0),
            lambda a, c: a + F.when(c == "", 0.0).otherwise(F.pow(F.length(x["body"]) - F.length(F.replace(x["body"], c, F.lit(""))), F.lit(2.0))),
        )
        chi = k / n * squares - n
        p_chi = _upper_tail((chi - (k - 1)) / F.sqrt(2 * (k - 1) * (n - 1) / n))
        codes = F.transform(F.split(x["body"], ""), lambda c: F.instr(x["alphabet"], c).cast("double"))
        # running sums: previous code, runs, high codes, sum, squares, lagged products
        zero = F.struct(*[F.lit(v).alias(c) for v, c in ((-1.0, "last"), (0.0, "runs"), (0.0, "high"), (0.0, "s"), (0.0, "ss"), (0.0, "lag"))])

        def step(a: Column, c: Column) -> Column:
            high = F.when(c > k / 2, 1.0).otherwise(0.0)
            was = F.when(a["last"] > k / 2, 1.0).otherwise(0.0)
            return F.struct(
                c.alias("last"),
                (a["runs"] + F.when((a["last"] < 0) | (high != was), 1.0).otherwise(0.0)).alias("runs"),
                (a["high"] + high).alias("high"),
                (a["s"] + c).alias("s"),
                (a["ss"] + c * c).alias("ss"),
                (a["lag"] + F.when(a["last"] < 0, 0.0).otherwise(a["last"] * c)).alias("lag"),
            )

        def finish(a: Column) -> Column:
            n1, n2 = a["high"], n - a["high"]
            mu = 2 * n1 * n2 / n + 1
            var = (mu - 1) * (mu - 2) / (n - 1)
            p_runs = F.when(var > 0, F.least(2 * _upper_tail(F.abs((a["runs"] - mu) / F.sqrt(var))), F.lit(1.0))).otherwise(1e-12)
            mean = a["s"] / n
            spread = a["ss"] - n * mean * mean
            first = F.instr(x["alphabet"], F.substring(x["body"], 1, 1)).cast("double")
            lag = a["lag"] - mean * (2 * a["s"] - first - a["last"]) + (n - 1) * mean * mean
            r = lag / spread
            p_lag = F.when(spread > 1e-9, F.least(2 * _upper_tail(F.abs((r + 1 / n) * F.sqrt(n))), F.lit(1.0))).otherwise(1e-12)
            half = -(F.log(p_chi) + F.log(p_runs) + F.log(p_lag))
            return F.exp(-half) * (1 + half + half * half / 2)

        return F.aggregate(codes, zero, step, finish)

    one = F.array(F.struct(body.alias("body"), alphabet.alias("alphabet")))
    return F.element_at(F.transform(one, of), 1)


def length_class(n: Column) -> Column:
    """Length classes 20-31, 32-47, 48-95 and longer: short runs are tested among themselves."""
    return F.when(n < 32, 0).when(n < 48, 1).when(n < 96, 2).otherwise(3)


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, base (array of start, kind, end), runs (candidates with length class and p)."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    base = F.concat(matches(text, ASSIGN, 0, 6, 2), matches(text, ACCESS, 1, 20), matches(text, HEX, 2, 24))
    found = docs.select(F.col(id_col).alias("id"), base.alias("base"), matches(text, RUN, 3, 20).alias("runs"))
    spans = F.transform("base", lambda s: F.struct(s["start"].alias("start"), s["kind"].alias("kind"), s["end"].alias("end")))
    free = F.filter("runs", lambda r: ~F.exists(F.col("base"), lambda b: (b["start"] < r["end"]) & (r["start"] < b["end"])))
    tested = F.transform(
        free,
        lambda r: F.struct(
            r["start"].alias("start"), r["kind"].alias("kind"), r["end"].alias("end"),
            length_class(r["end"] - r["start"]).alias("len_class"), randomness_p(r["value"]).alias("p"),
        ),
    )
    return found.select("id", F.array_sort(spans).alias("base"), tested.alias("runs"))


def thresholds(scanned: DataFrame, fdr: float = FDR) -> DataFrame:
    """(len_class, cut): Benjamini-Hochberg bound of each length class; runs with
    p at or below it are not random. One histogram row per class and bin."""
    bins = F.floor(-F.log10("r.p") * _BINS).cast("int")
    hist = scanned.select(F.explode("runs").alias("r")).groupBy("r.len_class", bins.alias("bin")).count()
    upto = Window.partitionBy("len_class").orderBy(F.desc("bin"))
    whole = Window.partitionBy("len_class")
    top = F.pow(F.lit(10.0), -F.col("bin") / F.lit(float(_BINS)))
    ranked = hist.select("len_class", top.alias("top"), F.sum("count").over(upto).alias("i"), F.sum("count").over(whole).alias("m"))
    ok = F.col("top") <= F.col("i") * F.lit(fdr) / F.col("m")
    return ranked.groupBy("len_class").agg(F.coalesce(F.max(F.when(ok, F.col("top"))), F.lit(0.0)).alias("cut"))


def find_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, base spans and all spans (base plus ``random``), each ordered."""
    scanned = written(scan(docs, id_col, text_col), "secret-scan")
    cuts = thresholds(scanned).agg(F.map_from_entries(F.collect_list(F.struct("len_class", "cut"))).alias("cuts"))
    more = F.filter("runs", lambda r: r["p"] > F.coalesce(F.element_at(F.col("cuts"), r["len_class"]), F.lit(0.0)))
    more = F.transform(more, lambda r: F.struct(r["start"].alias("start"), r["kind"].alias("kind"), r["end"].alias("end")))
    # four length classes at most: one row of four numbers is broadcast
    return scanned.join(F.broadcast(cuts)).select(F.col("id").alias(id_col), "base", F.array_sort(F.concat("base", more)).alias("spans"))


def spans_text(spans: Column) -> Column:
    """kind:start:end, joined by commas in order."""
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ",")


@query("op10_secret_scan")
def op10_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contract columns for every row of documents."""
    found = find_secrets(docs_of(spark, sf_dir, "doc_id", "text"))

    def count(kind: int) -> Column:
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{KINDS[kind]}")

    return found.select("doc_id", count(0), count(1), count(2), F.sha2(spans_text(F.col("base")), 256).alias("base_sha256"), spans_text(F.col("spans")).alias("spans"))
