"""Quality rules: counts of words, symbols and repetitions, and the distance of a text from its language.

Every document has two histograms: characters by class, and common words of the languages below, all other words in one
cell. Their sums over all documents of a language, as the table names it, are the language's reference. A document is
rejected if the Jensen-Shannon distance (base 2, 0 to 1) of either histogram to its reference exceeds a limit. That of
words is ``WORD_PART`` of the distance that a text without any common word has, so it follows how common the words are in
the language; one in which they are rarer than ``LEAST_COMMON`` has ``WORD_LIMIT``. The guards: short texts are rejected by
the base rules and never reach the comparison, and a language with fewer than ``LEAST_REFERENCE`` words isn't compared with.

All of it is built from DataFrame functions. A document's words, windows and lines stay in its row; only the references,
one row per language, are added up over rows.

A null text has no words, so it fails the base rules. A null language is a language of its own. Null and repeated ids
pass through. Extra columns, also of the names used here, are carried along by ``kept_documents``. Empty tables stay empty.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from smelter.llm.shared import free_names, needed, small_side, stored

SPACE = " \t\n\x0b\x0c\r"
LEAST_WORDS = 50
MOST_REPEATED = 50
LEAST_REFERENCE = 1000
CLASS_LIMIT = 0.3
WORD_PART = 0.8
WORD_LIMIT = 0.28
LEAST_COMMON = 0.1
LANGUAGES = 10_000
#: Frequent words of English, French, German and Spanish.
COMMON = (
    "the of and to a in is that it for was on with as be by this are at from "
    "de la le et les des en un du une que pour est par qui dans avec sur pas au "
    "der die und den von zu das mit sich auf für ist im nicht dem ein eine als "
    "el y los se del las por con no su para es al lo"
).split()
CLASSES = {"upper": "[A-Z]", "digit": "[0-9]", "vowel": "[aeiou]", "punctuation": "[.,;:!?'\"()\\[\\]{}/@_-]"}


def described(docs: DataFrame) -> DataFrame:
    """The base counts and both histograms of every document, beside ``doc_id`` and ``lang``."""
    rows = needed(docs, {"doc_id": "long", "lang": "string", "text": "string"}).withColumn("text", F.coalesce("text", F.lit("")))
    inner = F.btrim("text", F.lit(SPACE))
    rows = rows.withColumn("words", F.when(inner == "", F.array().cast("array<string>")).otherwise(F.split(inner, "[\\x20\\x09-\\x0D]+")))
    lines = F.filter(F.split("text", "\n"), lambda x: F.btrim(x, F.lit(SPACE)) != "")
    rows = rows.select(
        "doc_id", "lang", "text", "words",
        F.size("words").cast("long").alias("n_words"),
        F.char_length(F.array_join("words", "")).cast("long").alias("word_chars"),
        _matches("[#*$%&|<>]").alias("n_symbols"),
        _bound(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines"),
        _repeated_words(F.col("words")).cast("long").alias("n_repeat_words"),
        F.concat(F.lit(" "), F.lower(F.array_join(F.filter("words", lambda w: F.lower(w).isin(COMMON)), "  ")), F.lit(" ")).alias("common"),
    )
    failed = (F.col("n_words") < LEAST_WORDS) | (F.col("n_repeat_words") * 100 > F.col("n_words") * MOST_REPEATED)
    classes = [_matches(c) for c in CLASSES.values()]
    # The rest are bytes after a character's first, white space, symbols, and all other characters in words.
    classes += [(F.octet_length("text") - F.char_length("text")).cast("long"), F.char_length("text") - F.col("word_chars"), F.col("n_symbols")]
    words = [_occurrences(w) for w in COMMON]
    keys = [k.alias(name) for k, name in zip(_keys(F.col("text"), F.col("lang")), ("text_key", "text_key_2"), strict=True)]
    return rows.select(
        *keys, "doc_id", "lang", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", failed.alias("base_failed"),
        _with_rest(classes, F.char_length("text").cast("long")).alias("classes"), _with_rest(words, F.col("n_words")).alias("common"),
    )


def _bound(value: Column, use) -> Column:
    """``use(value)``, with the value computed once."""
    return F.transform(F.array(value), use)[0]


def _matches(char_class: str) -> Column:
    """Number of characters of a class of ASCII characters."""
    return (F.octet_length("text") - F.octet_length(F.regexp_replace("text", char_class, ""))).cast("long")


def _occurrences(word: str) -> Column:
    mark = f" {word} "
    return ((F.octet_length("common") - F.octet_length(F.replace("common", F.lit(mark), F.lit("")))) / len(mark.encode())).cast("long")


def _with_rest(cells: list[Column], total: Column) -> Column:
    """The cells, and what is left of the total."""
    return _bound(F.array(*cells), lambda x: F.concat(x, F.array(F.greatest(total - F.aggregate(x, F.lit(0).cast("long"), lambda a, b: a + b), F.lit(0).cast("long")))))


def _repeated_words(words: Column) -> Column:
    """Words in three-word windows that occur at least twice in the text."""
    windows = F.slice(F.transform(words, lambda w, i: F.xxhash64(w, F.get(words, i + 1), F.get(words, i + 2))), 1, F.greatest(F.size(words) - 2, F.lit(0)))

    def covered(w: Column) -> Column:
        ordered = F.sort_array(F.transform(w, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

        def twice(s: Column) -> Column:
            found = F.filter(s, lambda x, j: F.coalesce(x["h"] == F.get(s, j - 1)["h"], F.lit(False)) | F.coalesce(x["h"] == F.get(s, j + 1)["h"], F.lit(False)))
            return F.size(F.array_distinct(F.flatten(F.transform(found, lambda x: F.array(x["i"], x["i"] + 1, x["i"] + 2)))))

        return F.when(F.size(F.array_distinct(w)) == F.size(w), F.lit(0)).otherwise(_bound(ordered, twice))

    return F.when(F.size(words) < 3, F.lit(0)).otherwise(_bound(windows, covered))


def references(facts: DataFrame) -> DataFrame:
    """Both histograms' sums per language, and the limit of the words' distance."""
    n_classes, n_words = len(CLASSES) + 4, len(COMMON) + 1
    sums = [F.sum(F.col("classes")[i]).alias(f"c{i}") for i in range(n_classes)] + [F.sum(F.col("common")[i]).alias(f"w{i}") for i in range(n_words)]
    per_language = facts.groupBy("lang").agg(*sums)
    classes = F.array(*[f"c{i}" for i in range(n_classes)])
    words = F.array(*[f"w{i}" for i in range(n_words)])
    common_words = _total(words) - F.col(f"w{n_words - 1}") >= _total(words) * LEAST_COMMON
    without = F.lit([0] * (n_words - 1) + [1]).cast("array<long>")
    limit = F.when(common_words, distance(without, words) * WORD_PART).otherwise(F.lit(WORD_LIMIT))
    return per_language.select(F.col("lang").alias("reference"), classes.alias("reference_classes"), words.alias("reference_common"), limit.alias("word_limit"))


def _total(cells: Column) -> Column:
    return F.aggregate(cells, F.lit(0).cast("long"), lambda a, b: a + b).cast("double")


def distance(a: Column, b: Column) -> Column:
    """Jensen-Shannon distance of two histograms, base 2; null if either is empty."""

    def share(p: Column, m: Column) -> Column:
        return F.when(p > 0, p * F.log2(p / m)).otherwise(F.lit(0.0))

    def both(totals: Column) -> Column:
        def cell(x: Column, y: Column) -> Column:
            return _bound(F.struct((x / totals[0]).alias("p"), (y / totals[1]).alias("q")), lambda s: (share(s["p"], (s["p"] + s["q"]) / 2) + share(s["q"], (s["p"] + s["q"]) / 2)) / 2)

        return F.sqrt(F.greatest(F.aggregate(F.zip_with(a, b, cell), F.lit(0.0), lambda s, x: s + x), F.lit(0.0)))

    return _bound(F.array(_total(a), _total(b)), lambda t: F.when((t[0] > 0) & (t[1] > 0), both(t)))


def _keys(text: Column, lang: Column) -> tuple[Column, Column]:
    text, lang = F.coalesce(text, F.lit("")), F.coalesce(F.concat(F.lit("."), lang), F.lit(""))
    return F.xxhash64(text, lang), F.xxhash64(lang, text, F.lit(1))


def quality(docs: DataFrame) -> DataFrame:
    """The base counts, ``base_failed`` and ``kept`` per document, and both distances."""
    return compared(docs).drop("text_key", "text_key_2")


def compared(docs: DataFrame) -> DataFrame:
    """``quality``, with two hashes of text and language."""
    facts = stored(described(docs), "facts")
    language = small_side(stored(references(facts), "references"), LANGUAGES)
    joined = facts.join(language, facts["lang"].eqNullSafe(language["reference"]), "left")
    long_enough = ~F.col("base_failed") & (_total(F.col("reference_common")) >= LEAST_REFERENCE)
    by_class, by_word = (F.when(long_enough, distance(F.col(c), F.col(f"reference_{c}"))) for c in ("classes", "common"))
    base = ["text_key", "text_key_2", "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]
    measured = joined.select(*base, by_class.alias("class_distance"), by_word.alias("word_distance"), "word_limit")
    fine = (F.coalesce("class_distance", F.lit(0.0)) <= CLASS_LIMIT) & F.coalesce(F.col("word_distance") <= F.col("word_limit"), F.lit(True))
    return measured.select(*base, (~F.col("base_failed") & fine).alias("kept"), "class_distance", "word_distance")


def kept_documents(docs: DataFrame) -> DataFrame:
    """The documents that the rules keep, with all their columns.

    A verdict depends on text and language alone, so it is found again by two hashes of these, whatever the ids are.
    """
    names = list(free_names(docs, "text_key", "text_key_2"))
    rejected = stored(compared(docs).filter(~F.col("kept")).select(F.col("text_key").alias(names[0]), F.col("text_key_2").alias(names[1])).distinct(), "rejected")
    columns = [docs[c].cast("string") if c in docs.columns else F.lit(None).cast("string") for c in ("text", "lang")]
    keys = _keys(*columns)
    return docs.join(small_side(rejected), (keys[0] == rejected[names[0]]) & (keys[1] == rejected[names[1]]), "left_anti")
