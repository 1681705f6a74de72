r"""Secret scan with a randomness test battery, with DataFrame functions only.

Plain kinds are found by their patterns: `assign`, `access` and `hex`. The battery adds `random`: every run of 20 or
more characters of [A-Za-z0-9+/_-] gets the encoding that its characters allow (hex, base32, base36, base64, each in the
case or dialect that fits; at least one digit and one letter, for base64 in both cases), and three tests of the
hypothesis that its symbols are drawn at random from that alphabet:

* chi-squared uniformity over equal ranges of the alphabet (4, 8 or 16, as the length allows five in each);
* Wald-Wolfowitz runs about the middle of the alphabet;
* lag-one serial correlation of the symbols' places in the alphabet.

Fisher's method combines them to the p-value of randomness, which is uniform for random runs and near 0 for structured
ones. What is reported is what exceeds a limit of its own in each band of lengths (short runs have little power), and the
share of structured runs among the reported, the false findings, is estimated and held at `FDR` (above it where short structured runs look random): runs with a p-value above one fifth count
as random and tell how many random runs there are (Storey's estimate), so how many of the reported are not random follows
for every limit, and the least limit that keeps the rate is taken. Runs that the battery cannot tell from random ones
count as such; one run more than is seen is taken for random, so that a few runs in a small table are reported. P-values
are counted in steps of a tenth of a decade, so this needs one small table of counts and no global sort.

Results: a null or empty text has no spans. Spans are in code points, ends exclusive, ordered by start, then kind.
Equal rows give equal results. Which runs are reported as random depends on the whole table, as false findings are controlled
over all of its runs: the same run can be reported in one table and not in another. An empty table gives an empty one.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from terrane.llm.arrow import shielding
from terrane.llm.storage import saved

ASSIGN = r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
#: Runs of A-Z0-9 after AKIA, and of 0-9a-f, are taken whole; so a least length in the pattern drops what is shorter.
ACCESS = r"AKIA[A-Z0-9]{16,}"
HEX = r"[0-9a-f]{24,}"
TOKEN = r"[A-Za-z0-9+/_-]{20,}={0,2}"
KINDS = ("assign", "access", "hex", "random")

#: Alphabets by encoding, in the order in which they are tried, each with what a run must match.
ENCODINGS = (
    ("hex", r"^(?=.*[0-9])(?=.*[a-f])[0-9a-f]+$", "0123456789abcdef"),
    ("HEX", r"^(?=.*[0-9])(?=.*[A-F])[0-9A-F]+$", "0123456789ABCDEF"),
    ("base32", r"^(?=.*[2-7])(?=.*[A-Z])[A-Z2-7]+=*$", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"),
    ("base32 lower", r"^(?=.*[2-7])(?=.*[a-z])[a-z2-7]+=*$", "abcdefghijklmnopqrstuvwxyz234567"),
    ("BASE36", r"^(?=.*[0-9])(?=.*[A-Z])[0-9A-Z]+$", "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZ"),
    ("base36", r"^(?=.*[0-9])(?=.*[a-z])[0-9a-z]+$", "0123456789abcdefghijklmnopqrstuvwxyz"),
    ("base64", r"^(?=.*[0-9])(?=.*[A-Z])(?=.*[a-z])[A-Za-z0-9+/]+=*$", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"),
    ("base64url", r"^(?=.*[0-9])(?=.*[A-Z])(?=.*[a-z])[A-Za-z0-9_-]+=*$", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789-_"),
)
#: Lower ends of the bands of length.
BANDS = (20, 32, 48, 80)
#: Share of structured runs among the reported ones.
FDR = 0.05
#: P-values above one fifth are the first SURE_STEPS steps.
STEPS_A_DECADE, MOST_STEPS, SURE_STEPS = 10, 3000, 7


SPAN = "array<struct<start:int,stop:int,text:string>>"
#: Matches of one run (speed only).
SPAN_RUN = 128


def _once(value: Column, use) -> Column:
    """use(value), with `value` computed once however often it is used."""
    return F.get(F.transform(F.array(value), use), 0)


def _found(text: str, pattern: str) -> Column:
    """Array of (start, stop, text) of the pattern's matches from the left.

    `split` gives what stands between the matches, so both arrays together give the places. `aggregate` copies what it
    gathers at each step, so places are counted in runs of SPAN_RUN matches first and moved by the ends of the runs before.
    """
    matches = F.regexp_extract_all(F.col(text), F.lit(pattern), F.lit(0))
    # The last piece of text has no match after it and comes without a pair.
    pairs = F.arrays_zip(matches.alias("m"), F.slice(F.split(F.col(text), pattern, -1), 1, F.regexp_count(F.col(text), F.lit(pattern))).alias("g"))
    none = F.array().cast(SPAN)

    def add(run: Column, x: Column) -> Column:
        start = F.coalesce(F.get(run, F.size(run) - 1)["stop"], F.lit(0)) + F.char_length(x["g"])
        one = F.struct(start.alias("start"), (start + F.char_length(x["m"])).alias("stop"), x["m"].alias("text"))
        return F.concat(run, F.array(one))

    def runs(p: Column) -> Column:
        return F.transform(F.sequence(F.lit(1), F.size(p), F.lit(SPAN_RUN)), lambda i: F.aggregate(F.slice(p, i, SPAN_RUN), none, add))

    def ends(r: Column) -> Column:
        """Where each run begins; one place more than there are runs."""
        return F.aggregate(r, F.array(F.lit(0)), lambda acc, run: F.concat(acc, F.array(F.get(acc, F.size(acc) - 1) + F.get(run, F.size(run) - 1)["stop"])))

    def moved(run: Column, by: Column) -> Column:
        return F.transform(F.coalesce(run, none), lambda x: F.struct((x["start"] + by).alias("start"), (x["stop"] + by).alias("stop"), x["text"].alias("text")))

    whole = _once(pairs, lambda p: _once(runs(p), lambda r: F.flatten(F.zip_with(r, ends(r), moved))))
    return F.when(F.col(text).rlike(pattern), whole).otherwise(none)


def _case(what: str, results: list[tuple[str, str]]) -> str:
    return "CASE " + " ".join(f"WHEN {what} RLIKE '{p}' THEN {r}" for p, r in results) + " END"


def _upper_normal(z: str) -> str:
    """P(Z > z): Abramowitz and Stegun 26.2.17; beyond 6 the leading term of the tail."""
    t = f"(1 / (1 + 0.2316419D * abs({z})))"
    poly = f"{t} * (0.319381530D + {t} * (-0.356563782D + {t} * (1.781477937D + {t} * (-1.821255978D + {t} * 1.330274429D))))"
    tail = f"exp(-{z} * {z} / 2) / {math.sqrt(2 * math.pi)!r}D * CASE WHEN abs({z}) > 6 THEN 1 / abs({z}) ELSE {poly} END"
    return f"(CASE WHEN {z} >= 0 THEN {tail} ELSE 1 - {tail} END)"


def _tested(df: DataFrame, runs: str, out: str) -> DataFrame:
    """Replace the array `runs` of (start, stop, text) by `out`: (start, stop, encoding, n, p) of those with an encoding."""
    named = _case("r.text", [(p, f"'{e}'") for e, p, _ in ENCODINGS])
    letters = _case("r.text", [(p, f"'{a}'") for _, p, a in ENCODINGS])
    stages = [
        f"transform({runs}, r -> struct(r.start, r.stop, {named} AS encoding, {letters} AS letters, rtrim('=', r.text) AS body))",
        f"transform(filter({out}, r -> r.encoding IS NOT NULL), r -> struct(r.start, r.stop, r.encoding, length(r.letters) AS k, length(r.body) AS n,"
        " transform(filter(split(r.body, ''), c -> c <> ''), c -> locate(c, r.letters) - 1) AS v,"
        " CASE WHEN length(r.body) >= 80 THEN 16 WHEN length(r.body) >= 40 THEN 8 ELSE 4 END AS bins))",
        f"transform({out}, r -> struct(r.start, r.stop, r.encoding, r.n, r.k, r.bins,"
        " aggregate(sequence(0, r.bins - 1), 0D, (a, j) -> a + pow(size(filter(r.v, y -> y * r.bins div r.k = j)), 2)) * r.bins / r.n - r.n AS chi,"
        " CAST(size(filter(r.v, y -> y * 2 >= r.k)) AS DOUBLE) AS ones,"
        " 1D + size(filter(zip_with(slice(r.v, 1, r.n - 1), slice(r.v, 2, r.n - 1), (x, y) -> (x * 2 >= r.k) <> (y * 2 >= r.k)), c -> c)) AS runs,"
        " aggregate(zip_with(slice(r.v, 1, r.n - 1), slice(r.v, 2, r.n - 1), (x, y) -> (x - (r.k - 1) / 2) * (y - (r.k - 1) / 2)), 0D, (a, c) -> a + c)"
        " / sqrt(CAST(r.n - 1 AS DOUBLE)) / ((CAST(r.k AS DOUBLE) * r.k - 1) / 12) AS serial))",
        # z of each test: Wilson and Hilferty's cube root; the normal limits of the number of runs and of the correlation
        f"transform({out}, r -> struct(r.start, r.stop, r.encoding, r.n,"
        " (cbrt(r.chi / (r.bins - 1)) - 1 + 2D / (9 * (r.bins - 1))) / sqrt(2D / (9 * (r.bins - 1))) AS z1,"
        " CASE WHEN r.ones = 0 OR r.ones = r.n THEN sqrt(CAST(r.n AS DOUBLE)) ELSE (r.runs - 1 - 2 * r.ones * (r.n - r.ones) / r.n)"
        " / sqrt(greatest(1e-9D, (2 * r.ones * (r.n - r.ones) / r.n) * (2 * r.ones * (r.n - r.ones) / r.n - 1) / (r.n - 1))) END AS z2, r.serial AS z3))",
        f"transform({out}, r -> struct(r.start, r.stop, r.encoding, r.n, greatest(1e-300D, {_upper_normal('r.z1')}) AS p1,"
        f" greatest(1e-300D, 2 * {_upper_normal('abs(r.z2)')}) AS p2, greatest(1e-300D, 2 * {_upper_normal('abs(r.z3)')}) AS p3))",
        f"transform({out}, r -> struct(r.start, r.stop, r.encoding, r.n, -ln(r.p1) - ln(r.p2) - ln(r.p3) AS h))",
        # Fisher: twice h has six degrees of freedom
        f"transform({out}, r -> struct(r.start, r.stop, r.encoding, r.n, least(1D, exp(-r.h) * (1 + r.h + r.h * r.h / 2)) AS p))",
    ]
    for stage in stages:
        df = df.withColumn(out, F.expr(stage))
    return df.drop(runs)


def _band(n: str) -> str:
    return "CASE " + " ".join(f"WHEN {n} >= {b} THEN {b}" for b in reversed(BANDS)) + f" ELSE {BANDS[0]} END"


def _step(p: str) -> str:
    return f"least({MOST_STEPS}, CAST(floor(-log10(greatest({p}, 1e-300D)) * {STEPS_A_DECADE}) AS INT))"


def limits(tested: DataFrame, column: str, rate: float = FDR) -> dict[int, int]:
    """For each band the last step of p-values that is reported at that rate of false findings; at most one entry a band."""
    counts = tested.select(F.explode(column).alias("r")).selectExpr(f"{_band('r.n')} AS band", f"{_step('r.p')} AS step").groupBy("band", "step").count()
    # At most MOST_STEPS rows a band.
    every = Window.partitionBy("band")
    larger = every.orderBy("step").rowsBetween(Window.unboundedPreceding, 0)
    upper = F.sum(F.when(F.col("step") < SURE_STEPS, F.col("count"))).over(every)
    random = (F.coalesce(upper, F.lit(0)) + 1) / (1 - 10 ** (-SURE_STEPS / STEPS_A_DECADE))
    above = 1 - F.pow(F.lit(10.0), -(F.col("step") + 1) / STEPS_A_DECADE)
    kept = (
        counts.withColumns({"reported": F.sum("count").over(larger), "random": random * above})
        .where(F.col("reported") - F.col("random") <= rate * F.col("reported"))
        .groupBy("band")
        .agg(F.max("step").alias("step"))
    )
    return {r["band"]: r["step"] for r in kept.collect()}


@shielding
def scanned(df: DataFrame, text: str = "text", rate: float = FDR, keep_text: bool = True) -> DataFrame:
    """Add `secrets`: array of (start, kind number, stop, kind) in order; `kind` is one of KINDS.

    A column of `df` with that name is replaced. `keep_text=False` drops the texts once they are scanned.
    """
    df = df.drop("secrets")
    found = df.withColumns({
        "__assign": _found(text, ASSIGN), "__access": _found(text, ACCESS), "__hex": _found(text, HEX), "__random": _found(text, TOKEN),
    })
    found = found.withColumn("__assign", F.filter("__assign", lambda s: F.char_length(F.regexp_extract(s["text"], ASSIGN, 1)) >= 6))
    found = _tested(found, "__random", "__tested")
    found = saved(found if keep_text else found.drop(text), "scanned")
    last = limits(found, "__tested", rate)
    report = "CASE " + " ".join(f"WHEN {_band('r.n')} = {b} THEN {_step('r.p')} <= {s}" for b, s in sorted(last.items())) + " ELSE false END" if last else "false"
    found = found.withColumn("__random", F.expr(f"filter(__tested, r -> {report})"))
    named = ", ".join(f"transform(__{k}, s -> struct(s.start AS start, {i} AS number, s.stop AS stop, '{k}' AS kind))" for i, k in enumerate(KINDS))
    return found.withColumn("secrets", F.expr(f"array_sort(concat({named}))")).drop("__assign", "__access", "__hex", "__random", "__tested")


def joined(spans: str) -> Column:
    """Spans as kind:start:end, comma-joined."""
    return F.expr(f"array_join(transform({spans}, s -> concat_ws(':', s.kind, s.start, s.stop)), ',')")
