"""Quality rules with built-in functions only: repetition, and distance from a language's profile.

Every document gets two histograms: classes of characters, and the common words of its language. The
references are the same histograms added up over all documents of the language. A document whose
Jensen-Shannon distance (base 2, so 0 to 1) from a reference is above the limit fails; a histogram
with too few counts is not judged. Fixed base rules on length and repeated word windows come first.

Windows of words are compared by 64-bit hashes of 64-bit word hashes, inside one text only.
NULL and empty texts have no words and fail the base rule. A language without a word list, or NULL,
is judged by characters only, against the profile of all such documents. Nothing is shuffled but one
row of sums per language and task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tiffin.session import materialise

# Common words of each language (fixed values); other languages share one profile without words.
COMMON = {
    "en": ["the", "of", "and", "to", "in", "a", "is", "that", "it", "for", "on", "was", "with",
           "as", "be", "by"],
    "de": ["der", "die", "und", "in", "den", "von", "zu", "das", "mit", "sich", "des", "auf",
           "ist", "im", "dem", "als"],
    "fr": ["de", "la", "le", "et", "les", "des", "en", "un", "du", "une", "que", "est", "pour",
           "qui", "dans", "par"],
    "es": ["de", "la", "que", "el", "en", "y", "a", "los", "del", "se", "las", "por", "un",
           "para", "con", "no"],
}
WORDS = 16
CLASSES = ("upper", "digit", "space", "mark", "symbol", "beyond_ascii", "other")
BLANKS = " \t\n\x0b\f\r"
SPACE = "[ \\t\\n\\x0B\\f\\r]+"
SYMBOLS = "[#*$%&|<>]"
MARKS = "[.,;:!?'\"()\\[\\]{}/\\\\_=+@^~`-]"
WINDOW = 8
MIN_WORDS, MAX_REPEAT, OF = 20, 30, 100
MIN_CHARS, MIN_COMMON = 200, 25
MAX_CLASS_DISTANCE, MAX_WORD_DISTANCE = 0.30, 0.60


def measures(docs: DataFrame, text: str = "text") -> DataFrame:
    """Counts per document: n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, the class
    histogram c0.. and the common-word histogram w0.. ; needs doc_id, lang and the text."""
    t = F.coalesce(F.col(text), F.lit(""))
    bare = F.btrim("t", F.lit(BLANKS))
    none = F.array().cast("array<string>")
    df = docs.select("doc_id", F.when(F.col("lang").isin(*COMMON), F.col("lang")).otherwise("")
                     .alias("lang"), t.alias("t")).select("*", bare.alias("bare"))
    df = df.select("doc_id", "lang", "t",
                   F.when(F.col("bare") == "", none).otherwise(F.split("bare", SPACE)).alias("words"),
                   F.filter(F.split("t", "\n"), lambda x: F.btrim(x, F.lit(BLANKS)) != "")
                   .alias("lines"))
    df = df.select(
        "doc_id", "lang", F.size("words").alias("n"),
        F.length("t").alias("n_chars"), F.length(F.array_join("words", "")).alias("word_chars"),
        F.regexp_count("t", F.lit(SYMBOLS)).alias("n_symbols"),
        F.regexp_count("t", F.lit("[A-Z]")).alias("upper"),
        F.regexp_count("t", F.lit("[0-9]")).alias("digit"),
        F.regexp_count("t", F.lit(MARKS)).alias("mark"),
        (F.octet_length("t") - F.length("t")).alias("beyond_ascii"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).alias("n_dup_lines"),
        F.filter(F.transform("words", F.lower), lambda w: w.isin(
            *sorted({x for ws in COMMON.values() for x in ws}))).alias("common"),
        F.transform("words", lambda w: F.xxhash64(w)).alias("h"))
    windows = F.when(F.col("n") >= WINDOW, F.transform(
        F.sequence(F.lit(1), F.col("n") - (WINDOW - 1)),
        lambda i: F.xxhash64(F.slice("h", i, WINDOW))))
    df = df.select(*[c for c in df.columns if c != "h"], windows.alias("win"))
    lists = {k: F.array(*map(F.lit, v)) for k, v in COMMON.items()}
    wanted = F.lit(None).cast("array<string>")
    for k, v in lists.items():
        wanted = F.when(F.col("lang") == k, v).otherwise(wanted)
    df = df.select("*", wanted.alias("wanted")).select(
        "doc_id", "lang", F.col("n").cast("long").alias("n_words"),
        *[F.col(c).cast("long").alias(c) for c in ("n_chars", "word_chars", "n_symbols",
                                                   "n_dup_lines", "upper", "digit", "mark",
                                                   "beyond_ascii")],
        F.transform("wanted", lambda c: F.size(F.filter("common", lambda w: w == c)))
        .alias("hist"),
        F.when(F.size(F.array_distinct("win")) < F.size("win"), _covered("win")).otherwise(0)
        .cast("long").alias("n_repeat_words"))
    space = F.col("n_chars") - F.col("word_chars")
    classes = [F.col("upper"), F.col("digit"), space, F.col("mark"), F.col("n_symbols"),
               F.col("beyond_ascii")]
    rest = F.greatest(F.lit(0).cast("long"), F.col("n_chars") - sum(classes[1:], classes[0]))
    return df.select(
        "doc_id", "lang", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        *[c.alias(f"c{i}") for i, c in enumerate([*classes, rest])],
        *[F.coalesce(F.get("hist", F.lit(i)), F.lit(0)).cast("long").alias(f"w{i}")
          for i in range(WORDS)])


def _covered(win: str) -> Column:
    """Words that lie in a window found at least twice."""
    pairs = F.array_sort(F.transform(win, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))
    places = F.transform(
        F.array(pairs), lambda p: F.array_sort(F.transform(
            F.filter(F.transform(p, lambda x, k: F.struct(
                x["i"].alias("i"),
                ((F.get(p, k - 1)["h"] == x["h"]) | (F.get(p, k + 1)["h"] == x["h"])).alias("twice")
            )), lambda x: F.coalesce(x["twice"], F.lit(False))), lambda x: x["i"])))
    start = F.struct(F.lit(0).alias("end"), F.lit(0).alias("total"))
    return F.aggregate(F.get(places, F.lit(0)), start, lambda s, i: F.struct(
        (i + WINDOW).alias("end"),
        (s["total"] + i + WINDOW - F.greatest(s["end"], i)).alias("total")), lambda s: s["total"])


def references(counted: DataFrame) -> dict[str, tuple[list[float], list[float]]]:
    """Profiles by language, from all documents; at most one row per language with a word list,
    and one for the rest."""
    names = [f"c{i}" for i in range(len(CLASSES))] + [f"w{i}" for i in range(WORDS)]
    out = {}
    for r in counted.groupBy("lang").agg(*[F.sum(c).alias(c) for c in names]).collect():
        split = [[float(r[c]) for c in names if c[0] == kind] for kind in "cw"]
        out[r.lang] = tuple([x / sum(h) if sum(h) else 0.0 for x in h] for h in split)
    return out


def _distance(columns: list[str], reference: Column) -> Column:
    """Jensen-Shannon distance of counts from a distribution; 0 without counts."""
    total = sum((F.col(c) for c in columns[1:]), F.col(columns[0])).cast("double")
    parts = []
    for i, c in enumerate(columns):
        p = F.col(c) / F.when(total > 0, total)
        q = reference[i]
        m = (p + q) / 2
        parts.append(F.when(p > 0, p * F.log2(p / m)).otherwise(0.0)
                     + F.when(q > 0, q * F.log2(q / m)).otherwise(0.0))
    half = sum(parts[1:], parts[0]) / 2
    return F.coalesce(F.sqrt(F.greatest(half, F.lit(0.0))), F.lit(0.0))


def judge(counted: DataFrame, profiles: dict[str, tuple[list[float], list[float]]]) -> DataFrame:
    """Add class_distance, word_distance, base_failed and kept."""
    def pick(which: int, size: int) -> Column:
        out = F.array(*[F.lit(0.0)] * size)
        for lang, profile in sorted(profiles.items()):
            out = F.when(F.col("lang") == lang,
                         F.array(*map(F.lit, profile[which]))).otherwise(out)
        return out
    cs, ws = [f"c{i}" for i in range(len(CLASSES))], [f"w{i}" for i in range(WORDS)]
    df = counted.select("*", pick(0, len(cs)).alias("class_ref"), pick(1, WORDS).alias("word_ref"))
    n_common = sum((F.col(w) for w in ws[1:]), F.col(ws[0]))
    chars = sum((F.col(c) for c in cs[1:]), F.col(cs[0]))
    df = df.select("*", _distance(cs, F.col("class_ref")).alias("class_distance"),
                   _distance(ws, F.col("word_ref")).alias("word_distance"))
    failed = (F.col("n_words") < MIN_WORDS) | (OF * F.col("n_repeat_words")
                                               > MAX_REPEAT * F.col("n_words"))
    far = (((chars >= MIN_CHARS) & (F.col("class_distance") > MAX_CLASS_DISTANCE))
           | ((n_common >= MIN_COMMON) & (F.col("word_distance") > MAX_WORD_DISTANCE)))
    return df.select("*", failed.alias("base_failed"), (~failed & ~far).alias("kept")) \
        .drop("class_ref", "word_ref")


def verdicts(docs: DataFrame) -> DataFrame:
    """The counts are written once, as both the references and the verdicts need them."""
    counted = materialise(measures(docs.select("doc_id", "lang", "text")), "measures")
    return judge(counted, references(counted)).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", "kept")
