r"""Secret scan with a randomness test battery, DataFrame functions only.

*Base spans*, leftmost non-overlapping per kind: ``assign`` (a name like
password, token or api_key, a ``:`` or ``=`` and a value of 6+ characters),
``access`` (``AKIA`` and capitals or digits, 20+ characters) and ``hex`` (24+
lower-case hex digits).

*Battery*: every other run ``[A-Za-z0-9+/_-]{20,}`` with at least one digit and
one letter is a candidate (kind ``random``) unless it lies inside a base span.
Its encoding is inferred from its characters (hex, HEX, base32, base62, base64,
base64url: the first whose alphabet holds them all), and three tests ask whether it looks
drawn evenly from that alphabet:

* chi-squared of its character counts against uniformity (Wilson-Hilferty);
* runs of characters from the lower and upper half of the alphabet
  (Wald-Wolfowitz, two-sided);
* lag-1 serial correlation of the characters' numbers (two-sided).

The smallest of the three p-values, corrected for three tests, is the
candidate's p: about uniform for random strings, about 0 for words, paths and
repetitive strings.

*Length-aware false-discovery control*: candidates are counted by encoding,
length class and p bin over all documents.  In each length class the random
ones are estimated from the bins above one half (Storey), and the threshold is
the lowest p at which the candidates above it exceed the expected random ones
by a share of at most ``fdr``.  Short strings, which the tests separate badly,
thus need a higher p than long ones.  The estimate counts ``ASSUMED`` random
strings besides those seen, so that the lone random string of a small class is
not lost by the chance of its p, and no class size switches the rule: the more
candidates a class has, the less these weigh.  The table of thresholds has at
most encodings x length classes rows.

Defined cases: null text counts as empty; overlapping kinds are all listed;
equal spans of repeated rows are found in every row; further columns pass
through :func:`scan_secrets` (result column ``secrets``, underscores appended if
the name is taken).
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stratum.llm.common import free_name, table, written

ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{16,}"
HEX = r"[0-9a-f]{24,}"
CANDIDATE = r"[A-Za-z0-9+/_-]{20,}"

DIGITS, LOWER, UPPER = "0123456789", "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: Encodings in the order in which they are tried: name, alphabet, its pattern.
ENCODINGS = [
    ("hex", DIGITS + LOWER[:6], "^[0-9a-f]+$"),
    ("HEX", DIGITS + UPPER[:6], "^[0-9A-F]+$"),
    ("base32", UPPER + DIGITS[2:8], "^[A-Z2-7]+$"),
    ("base62", DIGITS + UPPER + LOWER, "^[0-9A-Za-z]+$"),
    ("base64", UPPER + LOWER + DIGITS + "+/", "^[0-9A-Za-z+/]+$"),
    ("base64url", UPPER + LOWER + DIGITS + "-_", "^[0-9A-Za-z_-]+$"),
]
#: Upper ends of the length classes (code points); the last class is open.
LENGTH_CLASSES = [24, 32, 48, 64, 128]
BINS = 50
#: Random strings with a p above one half that the Storey estimate takes for
#: granted in every class.
ASSUMED = 2
#: Matches per inner sum in :func:`offsets`.
STEP = 256


def offsets(sizes: Column) -> Column:
    """Running sums of an array of longs: ``n + 1`` numbers from 0.  Summed in
    steps, so that the cost stays near-linear for very many matches."""
    n = F.size(sizes)
    steps = F.transform(F.sequence(F.lit(0), F.floor(n / STEP).cast("int")),
                        lambda k: F.slice(sizes, k * STEP + 1, F.lit(STEP)))
    zero = F.lit(0).cast("bigint")

    def running(values: Column, start: Column) -> Column:
        return F.aggregate(values, F.array(start), lambda a, x: F.concat(a, F.array(F.element_at(a, -1) + x)))
    before = running(F.transform(steps, lambda s: F.aggregate(s, zero, lambda a, x: a + x)), zero)
    inner = F.transform(steps, lambda s, k: F.slice(running(s, F.element_at(before, k + 1)), F.lit(1), F.size(s)))
    return F.concat(F.flatten(inner), F.array(F.element_at(before, -1)))


def matches(text: Column, pattern: str, found: Column) -> Column:
    """Array of (start, end, piece): where the matches ``found`` (of the whole
    pattern, leftmost, non-overlapping) lie, in code points."""
    gaps = F.transform(F.split(text, pattern, -1), lambda p: F.char_length(p).cast("bigint"))
    gap_upto, own_upto = offsets(gaps), offsets(F.transform(found, lambda m: F.char_length(m).cast("bigint")))
    n = F.size(found)
    starts = F.zip_with(F.slice(gap_upto, F.lit(2), n), F.slice(own_upto, F.lit(1), n), lambda g, o: g + o)
    return F.zip_with(found, starts, lambda m, at: F.struct(
        at.alias("start"), (at + F.char_length(m)).alias("end"), m.alias("piece")))


def _spans(text: Column, pattern: str) -> Column:
    none = F.expr("cast(array() as array<struct<start:bigint,end:bigint,piece:string>>)")
    return F.when(F.rlike(text, F.lit(pattern)),
                  matches(text, pattern, F.regexp_extract_all(text, F.lit(pattern), 0))).otherwise(none)


def normal_tail(z: Column) -> Column:
    """P(Z > z) of a standard normal (Abramowitz and Stegun 7.1.26)."""
    x = F.abs(z) / F.lit(2 ** 0.5)
    t = 1 / (1 + F.lit(0.3275911) * x)
    poly = t * (0.254829592 + t * (-0.284496736 + t * (1.421413741 + t * (-1.453152027 + t * 1.061405429))))
    tail = poly * F.exp(-x * x) / 2
    return F.when(z >= 0, tail).otherwise(1 - tail)


def _pick(encoding: Column, values: list) -> Column:
    return reduce(lambda acc, ev: F.when(encoding == ev[0], F.lit(ev[1])).otherwise(acc),
                  reversed(list(zip([e[0] for e in ENCODINGS], values))), F.lit(None))


def infer_encoding(s: Column) -> Column:
    return F.coalesce(*[F.when(F.rlike(s, F.lit(p)), F.lit(name)) for name, _, p in ENCODINGS], F.lit("mixed"))


def battery(cands: DataFrame) -> DataFrame:
    """Adds encoding, chi_p, runs_p, serial_p and p to candidates with a column
    ``piece``; ``mixed`` strings fit no alphabet and have p 0."""
    d = cands.withColumn("encoding", infer_encoding(F.col("piece")))
    size = _pick(F.col("encoding"), [len(a) for _, a, _ in ENCODINGS])
    half = _pick(F.col("encoding"), ["0" * (len(a) // 2) + "1" * (len(a) - len(a) // 2) for _, a, _ in ENCODINGS])
    letters = _pick(F.col("encoding"), [a for _, a, _ in ENCODINGS])
    d = d.withColumn("k", size.cast("double")).withColumn("alphabet", letters).withColumn("half", half) \
        .withColumn("n", F.char_length("piece").cast("double")) \
        .withColumn("chars", F.split("piece", ""))
    d = d.withColumn("nums", F.transform("chars", lambda c: F.instr(F.col("alphabet"), c).cast("double")))
    # chi-squared: (k / n) * sum of squared counts - n
    d = d.withColumn("squares", F.aggregate(
        F.array_distinct("chars"), F.lit(0.0),
        lambda a, c: a + F.pow(F.col("n") - F.char_length(F.replace(F.col("piece"), c, F.lit(""))), F.lit(2.0))))
    chi, df = F.col("k") / F.col("n") * F.col("squares") - F.col("n"), F.col("k") - 1
    d = d.withColumn("chi_z", (F.pow(F.greatest(chi, F.lit(0.0)) / df, F.lit(1 / 3)) - (1 - 2 / (9 * df)))
                     / F.sqrt(2 / (9 * df)))
    # runs of the two halves of the alphabet
    d = d.withColumn("bits", F.expr("translate(piece, alphabet, half)"))
    d = d.withColumn("ones", F.char_length(F.regexp_replace("bits", "0", "")).cast("double")) \
        .withColumn("runs", F.char_length(F.regexp_replace(F.regexp_replace("bits", "0+", "0"), "1+", "1")))
    zeros = F.col("n") - F.col("ones")
    mean = 2 * F.col("ones") * zeros / F.col("n") + 1
    var = (mean - 1) * (mean - 2) / F.greatest(F.col("n") - 1, F.lit(1.0))
    d = d.withColumn("runs_z", F.when(var > 0, (F.col("runs") - mean) / F.sqrt(var)).otherwise(F.lit(9.0)))
    # lag-1 serial correlation of the characters' numbers
    mu = F.aggregate("nums", F.lit(0.0), lambda a, x: a + x) / F.col("n")
    d = d.withColumn("mu", mu)
    d = d.withColumn("dev", F.transform("nums", lambda x: x - F.col("mu")))
    d = d.withColumn("ss", F.aggregate("dev", F.lit(0.0), lambda a, x: a + x * x)) \
        .withColumn("cross", F.aggregate(
            F.zip_with("dev", F.slice("dev", F.lit(2), F.size("dev")), lambda x, y: x * F.coalesce(y, F.lit(0.0))),
            F.lit(0.0), lambda a, x: a + x))
    d = d.withColumn("serial_z", F.when(F.col("ss") > 0, F.sqrt("n") * (F.col("cross") / F.col("ss") + 1 / F.col("n")))
                     .otherwise(F.lit(9.0)))
    d = d.withColumn("chi_p", normal_tail(F.col("chi_z"))) \
        .withColumn("runs_p", F.least(F.lit(1.0), 2 * normal_tail(F.abs("runs_z")))) \
        .withColumn("serial_p", F.least(F.lit(1.0), 2 * normal_tail(F.abs("serial_z"))))
    low = F.least("chi_p", "runs_p", "serial_p")
    p = F.when(F.col("encoding") == "mixed", F.lit(0.0)).otherwise(1 - F.pow(1 - low, F.lit(3.0)))
    return d.withColumn("p", F.coalesce(p, F.lit(0.0))).drop(
        "k", "alphabet", "half", "n", "chars", "nums", "squares", "chi_z", "bits", "ones", "runs", "runs_z", "mu",
        "dev", "ss", "cross", "serial_z")


def length_class(size: Column) -> Column:
    return reduce(lambda acc, e: F.when(size <= e[1], F.lit(e[0])).otherwise(acc),
                  reversed(list(enumerate(LENGTH_CLASSES))), F.lit(len(LENGTH_CLASSES)))


def p_bin(p: Column) -> Column:
    return F.least(F.lit(BINS - 1), F.floor(p * BINS)).cast("int")


def thresholds(counts: list[tuple[str, int, int, int]], fdr: float) -> dict[tuple[str, int], int]:
    """Lowest p bin accepted per (encoding, length class), from counts per bin."""
    table_: dict[tuple[str, int], list[int]] = {}
    for encoding, size, b, n in counts:
        table_.setdefault((encoding, size), [0] * BINS)[b] += n
    out = {}
    for key, bins in sorted(table_.items()):
        # per bin, were all above one half random
        random_ones = (sum(bins[BINS // 2:]) + ASSUMED) / (BINS - BINS // 2)
        above, best = 0, BINS
        for b in range(BINS - 1, -1, -1):
            above += bins[b]
            expected = random_ones * (BINS - b)
            if above and (above - expected) / above <= fdr:
                best = b
        # never below the bin of the lowest percentile of random strings
        out[key] = max(best, 1)
    return out


def scan_secrets(docs: DataFrame, fdr: float = 0.1) -> DataFrame:
    """``docs`` (but ``text``) plus ``secrets``: array of (kind, start, end), by start, then
    base kinds as listed (assign, access, hex), then ``random``."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    name = free_name(docs.columns, "secrets")
    row = F.struct(*[docs[c] for c in docs.columns if c != "text"]).alias("row")
    found = docs.select(row, text.alias("t"))
    # the pattern runs to the value's end; values under 6 characters still use up their match
    found = found.withColumn("assign", _spans(F.col("t"), ASSIGN)) \
        .withColumn("values", F.when(F.size("assign") > 0, F.regexp_extract_all("t", F.lit(ASSIGN), 2))
                    .otherwise(F.expr("cast(array() as array<string>)"))) \
        .withColumn("access", _spans(F.col("t"), ACCESS)).withColumn("hex", _spans(F.col("t"), HEX)) \
        .withColumn("runs", _spans(F.col("t"), CANDIDATE))
    valued = F.zip_with("assign", "values", lambda a, v: F.struct(a.alias("s"), v.alias("v")))
    kept = F.transform(F.filter(valued, lambda z: F.char_length(z["v"]) >= 6), lambda z: z["s"])

    def of_kind(rank: int, kind: str, spans: Column) -> Column:
        return F.transform(spans, lambda s: F.struct(
            s["start"].alias("start"), F.lit(rank).alias("rank"), s["end"].alias("end"), F.lit(kind).alias("kind")))
    base = F.array_sort(F.concat(of_kind(0, "assign", kept), of_kind(1, "access", F.col("access")),
                                 of_kind(2, "hex", F.col("hex"))))
    found = found.withColumn("base", base)
    mixed = F.filter("runs", lambda s: F.rlike(s["piece"], F.lit("[0-9]")) & F.rlike(s["piece"], F.lit("[A-Za-z]"))
                     & ~F.exists("base", lambda b: (b["start"] <= s["start"]) & (s["end"] <= b["end"])))
    scanned = written(found.select(
        F.monotonically_increasing_id().alias("id"), "row", "base", mixed.alias("cands")), "secret-candidates")
    cands = scanned.select("id", F.explode("cands").alias("c")).select("id", "c.start", "c.end", "c.piece")
    random_ones = random_pieces(cands.select("piece").distinct(), fdr)
    spans = cands.join(random_ones, "piece").select("id", F.struct(
        "start", F.lit(3).alias("rank"), "end", F.lit("random").alias("kind")).alias("s"))
    more = spans.groupBy("id").agg(F.collect_list("s").alias("more"))
    both = scanned.join(more, "id", "left").withColumn("all", F.array_sort(F.concat(
        "base", F.coalesce("more", F.expr("cast(array() as array<struct<start:bigint,rank:int,end:bigint,kind:string>>)")))))
    out = F.transform("all", lambda x: F.struct(x["kind"].alias("kind"), x["start"].alias("start"), x["end"].alias("end")))
    return both.select(*[F.col("row")[c].alias(c) for c in docs.columns if c != "text"], out.alias(name))


def random_pieces(pieces: DataFrame, fdr: float) -> DataFrame:
    """The distinct candidate strings (column ``piece``) accepted as random."""
    tested = written(battery(pieces).select("piece", "encoding", p_bin(F.col("p")).alias("bin")), "secret-battery")
    size = length_class(F.char_length("piece"))
    counts = tested.groupBy("encoding", size.alias("size"), "bin").agg(F.count("*").alias("n")).collect()
    least = thresholds([tuple(r) for r in counts], fdr)
    keys = [x for (enc, cls), b in least.items() for x in (F.lit(f"{enc}:{cls}"), F.lit(b))]
    if not keys:
        return tested.select("piece")
    floor = F.create_map(*keys)[F.concat("encoding", F.lit(":"), size.cast("string"))]
    return tested.where(F.col("bin") >= floor).select("piece")


def listing(spans: Column) -> Column:
    """kind:start:end of every span, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def op2_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets in every whole text of ``documents``."""
    found = scan_secrets(table(spark, sf_dir, "documents").select("doc_id", "text"))
    kinds = ["assign", "access", "hex"]
    base = F.filter("secrets", lambda s: s["kind"].isin(kinds))

    def count(kind: str) -> Column:
        return F.size(F.filter("secrets", lambda s: s["kind"] == kind)).cast("bigint").alias(f"n_{kind}")
    return found.select(
        "doc_id", *map(count, kinds),
        F.sha2(listing(base).cast("binary"), 256).alias("base_sha256"), listing(F.col("secrets")).alias("spans"))
