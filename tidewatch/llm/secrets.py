"""Secret scan: fixed rules, and Markov models of random and ordinary strings.

DataFrame functions only. Every text is searched whole.

Rules (leftmost, non-overlapping for each kind): ``assign`` (a keyword, then a
value of 6 or more characters), ``access`` (AKIA..., 20 or more), ``hex`` (24 or
more). A rule's places come from splitting the text at its matches: the lengths
of gaps and matches add up to code-point positions.

Method: two first-order character Markov models, of random strings and of
ordinary identifiers. They are trained from labelled samples: random ones are
digests of the ids of the sampled rows in base64, hexadecimal and upper-case
hexadecimal; ordinary ones are the words of 8 or more characters in those rows'
texts that no rule marks. The sample is bounded: the ``SAMPLE`` rows with the
smallest hash of their id. Bigram counts are summed by Spark; the driver gets
one log ratio for each pair of the 67 characters; what seldom follows a character is
estimated from how frequent it is by itself. A run of ``MIN_LENGTH`` or more
such characters that holds a letter and a digit is a candidate. Its part of the
highest summed log-likelihood ratio is a secret of kind ``random`` if the sum is
over ``threshold``, the part too has ``MIN_LENGTH`` characters, a letter and a
digit, and no rule's span overlaps it; so a random value behind a long ordinary
path or name is judged by itself. The span is that part, widened to the nearest
/, =, _ or - (or the end of the run) on both sides. A run gives one span at most.

Defined cases: null text is empty; empty texts have no spans; very long texts and
runs are read whole, in time that grows with their length; of parts with equal sums the
first one counts; without any ordinary words the smoothed models are still defined;
repeated rows get equal spans; null ids are kept; an empty table gives no rows; only
the id and the text are read, so no column's name can clash.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared import id_text

# The rules, in the order in which spans of equal start stand.
_KEY = r"((?i:password|passwd|secret|token|api_?key))"
RULES = {
    "assign": _KEY + r"""["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    "access": r"AKIA[A-Z0-9]{16,}",  # AKIA[A-Z0-9]+ of 20 or more characters
    "hex": r"[0-9a-f]{24,}",  # [0-9a-f]+ of 24 or more characters
}
LEAST_VALUE = 6  # characters of an assigned value

ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-"
MIN_LENGTH = 8
_CHARS = "A-Za-z0-9+/_=-"
# A run from its first character on, so that a long one is looked ahead over only once.
CANDIDATE = (rf"(?<![{_CHARS}])(?=[A-Za-z+/_=-]*+[0-9])(?=[0-9+/_=-]*+[A-Za-z])"
             rf"[{_CHARS}]{{{MIN_LENGTH},}}+")
SAMPLE = 20_000
BACK_OFF = 32  # pseudo-counts of a character's successors, shared out as the characters are by themselves
SPAN = "array<struct<start:int,kind:int,end:int>>"


def spans(text: Column, pattern: str, kind: int, keep=None, part=None) -> Column:
    """All matches of ``pattern`` as (start, kind, end) in code points. ``keep``
    maps (match, group 2) to a condition; ``part`` maps a match to the (from, to) of
    it that is the span, null for none."""
    rule = F.lit(pattern)
    value = F.regexp_extract_all(text, rule, F.lit(2 if keep else 0))
    gaps = F.split(text, pattern, -1).alias("gap")
    matches = F.regexp_extract_all(text, rule, F.lit(0))
    zipped = F.arrays_zip(gaps, matches.alias("match"), value.alias("value"))
    if part:
        zipped = F.arrays_zip(gaps, matches.alias("match"), F.transform(matches, part).alias("part"))

    def add(state: Column, item: Column) -> Column:
        start = state["at"] + F.length(item["gap"])
        end = start + F.coalesce(F.length(item["match"]), F.lit(0))
        wanted = item["match"].isNotNull() & (keep(item["match"], item["value"]) if keep else F.lit(True))
        span = F.struct(start.alias("start"), F.lit(kind).alias("kind"), end.alias("end"))
        if part:
            wanted = item["part"].isNotNull()
            span = F.struct((start + item["part"]["from"]).alias("start"), F.lit(kind).alias("kind"),
                            (start + item["part"]["to"]).alias("end"))
        return F.struct(end.alias("at"), F.when(wanted, F.array_append(state["found"], span))
                        .otherwise(state["found"]).alias("found"))

    state = F.struct(F.lit(0).alias("at"), F.array().cast(SPAN).alias("found"))
    found = F.aggregate(zipped, state, add, lambda s: s["found"])
    return F.when(F.rlike(text, rule), found).otherwise(F.array().cast(SPAN))


def base_spans(text: Column) -> Column:
    """Spans of the rules, by start, then kind as listed."""
    each = [spans(text, RULES["assign"], 0, lambda _, value: F.length(value) >= LEAST_VALUE),
            spans(text, RULES["access"], 1), spans(text, RULES["hex"], 2)]
    return F.array_sort(F.concat(*each))


def _pairs(word: Column) -> Column:
    """Neighbouring characters of a word as numbers: 67 * first + second."""
    at = F.transform(F.split(word, ""), lambda c: F.instr(F.lit(ALPHABET), c) - 1)
    n = F.size(at)
    return F.zip_with(F.slice(at, 1, F.greatest(n - 1, F.lit(0))), F.slice(at, 2, F.greatest(n - 1, F.lit(0))),
                      lambda a, b: a * len(ALPHABET) + b)


def train(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", sample: int = SAMPLE) -> list[float]:
    """log P(b | a, random) - log P(b | a, ordinary) of each character pair."""
    chosen = id_text(docs, id_col, text_col).select("id", F.xxhash64("id").alias("h")) \
        .orderBy("h", "id").limit(sample)  # a few numbers per row; the texts of these rows are joined
    rows = id_text(docs, id_col, text_col).join(F.broadcast(chosen.where("id is not null").distinct()), "id")
    digest = F.sha2(F.col("id").cast("string").cast("binary"), 256)
    random = rows.select(F.explode(F.array(F.base64(F.unhex(digest)), digest, F.upper(digest))).alias("word"))
    plain = F.col("text")
    for rule in RULES.values():
        plain = F.regexp_replace(plain, rule, " ")
    words = rows.select(F.explode(F.regexp_extract_all(plain, F.lit(r"[A-Za-z0-9+/_=-]{8,}"), F.lit(0))).alias("word"))
    ordinary = words.where(~F.rlike("word", F.lit("^[0-9]+$")))
    counted = (random.select("word", F.lit(1).alias("label")).unionByName(ordinary.select("word", F.lit(0).alias("label")))
               .select("label", F.explode(_pairs(F.col("word"))).alias("pair")).groupBy("pair").pivot("label", [0, 1])
               .count().na.fill(0).collect())
    size = len(ALPHABET)
    counts = {r["pair"]: (r["0"], r["1"]) for r in counted}
    ends = [[sum(counts.get(a * size + b, (0, 0))[y] for a in range(size)) for b in range(size)] for y in (0, 1)]
    alone = [[(n + 0.5) / (sum(row) + 0.5 * size) for n in row] for row in ends]  # of a character, whatever stands before it
    ratio = []
    for a in range(size):
        row = [counts.get(a * size + b, (0, 0)) for b in range(size)]
        totals = [sum(c[y] for c in row) for y in (0, 1)]
        log = [[math.log((c[y] + BACK_OFF * alone[y][b]) / (totals[y] + BACK_OFF)) for b, c in enumerate(row)] for y in (0, 1)]
        ratio += [r - o for o, r in zip(*log, strict=True)]
    return ratio


def _table(model: list[float]) -> Column:
    return F.split(F.lit(",".join(f"{x:.5f}" for x in model)), ",").cast("array<double>")  # folded to one literal


def log_ratio(word: Column, model: list[float]) -> Column:
    """Log-likelihood ratio of a word, random against ordinary."""
    return F.aggregate(_pairs(word), F.lit(0.0), lambda total, pair: total + F.get(_table(model), pair))


def best_part(word: Column, model: list[float]) -> Column:
    """(best, from, to): the part of a word with the highest summed log ratio, the
    first of equals; in one pass over its character pairs."""
    def add(s: Column, pair: Column) -> Column:
        ratio = F.get(_table(model), pair)
        goes_on = s["run"] > 0
        run = F.when(goes_on, s["run"] + ratio).otherwise(ratio)
        begin = F.when(goes_on, s["begin"]).otherwise(s["at"])
        better = run > s["best"]
        return F.struct((s["at"] + 1).alias("at"), run.alias("run"), begin.alias("begin"),
                        F.when(better, run).otherwise(s["best"]).alias("best"),
                        F.when(better, begin).otherwise(s["from"]).alias("from"),
                        F.when(better, s["at"] + 2).otherwise(s["to"]).alias("to"))

    zero, none = F.lit(0), F.lit(0.0)
    start = F.struct(zero.alias("at"), none.alias("run"), zero.alias("begin"), none.alias("best"), zero.alias("from"),
                     zero.alias("to"))
    return F.aggregate(_pairs(word), start, add)


def random_spans(text: Column, model: list[float], threshold: float) -> Column:
    def part(match: Column) -> Column:
        def judge(b: Column) -> Column:
            inner = F.substring(match, b["from"] + 1, b["to"] - b["from"])
            before = F.reverse(F.substring(match, F.lit(1), b["from"]))
            after = F.substring(match, b["to"] + 1, F.length(match))
            wide = F.struct((b["from"] - F.length(F.regexp_extract(before, "^[^/=_-]*+", 0))).alias("from"),
                            (b["to"] + F.length(F.regexp_extract(after, "^[^/=_-]*+", 0))).alias("to"))
            return F.when((b["best"] > threshold) & (F.length(inner) >= MIN_LENGTH) & F.rlike(inner, F.lit("[0-9]"))
                          & F.rlike(inner, F.lit("[A-Za-z]")), wide)

        return F.get(F.transform(F.array(best_part(match, model)), judge), F.lit(0))  # the best part is found once

    return spans(text, CANDIDATE, 3, part=part)


def scan_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = 8.0,
                 model: list[float] | None = None) -> DataFrame:
    """One row per row of ``docs``: id, base and found, arrays of (start, kind,
    end); kind counts ``RULES`` in order, then 3 for random strings."""
    model = model or train(docs, id_col, text_col)
    rows = id_text(docs, id_col, text_col)
    rows = rows.select(F.col("id").alias(id_col), base_spans(F.col("text")).alias("base"),
                       random_spans(F.col("text"), model, threshold).alias("extra"))
    fresh = F.filter("extra", lambda x: ~F.exists("base", lambda b: (b["start"] < x["end"]) & (x["start"] < b["end"])))
    return rows.select(id_col, "base", F.array_sort(F.concat("base", fresh)).alias("found"))


def written(column: Column) -> Column:
    """kind:start:end, comma-joined."""
    names = F.array(*[F.lit(k) for k in [*RULES, "random"]])
    return F.array_join(F.transform(column, lambda s: F.concat_ws(
        ":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ",")
