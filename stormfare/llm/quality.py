"""Quality rules: word and repetition figures, and divergence from the document's language.

A document's character-class histogram and its histogram of common words are
compared with those of its language by Jensen-Shannon distance (base 2, 0 to 1).
The references are sums over all documents of the language, so they follow the
corpus; only one row of sums per declared language reaches the driver.

Short documents are not judged by divergence: below ``MIN_WORDS`` words or
``MIN_LETTERS`` letters a histogram says little. Defined results: null text
counts as empty; a null or undeclared language is held against the nearest
reference; a language without any letters in the corpus has no reference, and
its documents are not judged; columns other than the named ones are ignored by
:func:`quality_report` and returned unchanged by :func:`keep_good`.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from stormfare.llm.text import let, only, whole_text
from stormfare.session import written

MIN_BASE_WORDS = 20
MAX_REPEAT_PERCENT = 30
WINDOW = 8
#: Guards and limits of the divergence rules.
MIN_WORDS = 40
MIN_LETTERS = 120
MAX_CLASS_DISTANCE = 0.30
#: The fewer words, the further a sound text may lie off by chance.
WORD_DISTANCE, WORD_DISTANCE_SPREAD = 0.13, 1.3

COMMON_WORDS = {
    "de": ("der", "die", "und", "den", "das", "ist", "nicht", "mit"),
    "en": ("the", "of", "and", "to", "in", "that", "is", "for"),
    "es": ("el", "los", "las", "la", "en", "un", "que", "de"),
    "fr": ("le", "la", "les", "de", "et", "des", "que", "une"),
}
LANGUAGES = tuple(COMMON_WORDS)
BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
CLASSES = ("lower", "upper", "digit", "space", "symbol", "other")


def _removed(text: str, pattern: str) -> Column:
    return F.regexp_replace(F.col(text), pattern, "")


def _length(name: str) -> Column:
    return F.length(F.col(name)).cast("long")


def with_classes(docs: DataFrame, text: str = "text") -> DataFrame:
    """Adds ``_classes``, the counts by character class, and what the word counts need.

    Lower-case letters, four fifths of a text, are taken out first, so the
    other classes are counted in what is left.
    """
    df = docs.withColumn("_text", whole_text(text))
    df = df.withColumns({
        "_rest": _removed("_text", r"\p{Ll}+"),
        "_spaced": F.concat(F.lit(" "), F.regexp_replace("_text", r"[\x09-\x0D]", " "), F.lit(" ")),
    })
    df = df.withColumns({
        "_no_upper": _removed("_rest", r"\p{Lu}+"),
        "_symbols": F.regexp_replace("_rest", r"[^#*$%&|<>]+", ""),
        "_words": F.array_remove(F.split("_spaced", " "), ""),
    })
    df = df.withColumns({
        "_no_digit": _removed("_no_upper", r"\p{Nd}+"),
        "n_words": F.size("_words").cast("long"),
    })
    df = df.withColumn("_no_space", _removed("_no_digit", r"[\x20\x09-\x0D]+"))
    return df.withColumn("_classes", F.array(
        _length("_text") - _length("_rest"),
        _length("_rest") - _length("_no_upper"),
        _length("_no_upper") - _length("_no_digit"),
        _length("_no_digit") - _length("_no_space"),
        _length("_symbols"),
        _length("_no_space") - _length("_symbols"),
    ))


def _pattern(listed: tuple[str, ...]) -> str:
    """Matches every word that is not listed, with the space before it."""
    return rf" (?!(?:{'|'.join(listed)}) )[^ ]*"


def _by_language(value: dict[str, Column], otherwise: Column) -> Column:
    """The value of the document's language; ``otherwise`` where that is not declared."""
    lang = F.col("_lang")
    declared = reduce(lambda c, k: c.when(lang == k, value[k]), value, F.when(F.lit(False), None))
    return F.when(lang.isNull() | ~lang.isin(*LANGUAGES), otherwise).otherwise(declared)


def with_histograms(docs: DataFrame, text: str = "text", lang: str = "lang") -> DataFrame:
    """Adds ``_classes`` and ``_common``: a language's common words counted as written, then all others.

    ``_common`` holds the counts for the document's language, or for each
    declared language where its own is not declared.
    """
    df = with_classes(docs, text).withColumn("_lang", F.col(f"`{lang}`"))
    everything = tuple(dict.fromkeys(w for listed in COMMON_WORDS.values() for w in listed))
    left = {k: F.regexp_replace("_spaced", _pattern(v), "") for k, v in COMMON_WORDS.items()}
    df = df.withColumn(
        "_left", _by_language(left, F.regexp_replace("_spaced", _pattern(everything), ""))
    )

    def counts(k: str) -> Column:
        listed = F.array(*[
            F.regexp_count(F.col("_left"), F.lit(f" {w}(?![^ ])")).cast("long") for w in COMMON_WORDS[k]
        ])
        return let(listed, lambda c: F.concat(c, F.array(
            F.col("n_words") - F.aggregate(c, F.lit(0).cast("long"), lambda s, v: s + v)
        )))

    own = {k: F.array(counts(k)) for k in LANGUAGES}
    return df.withColumn("_common", _by_language(own, F.array(*[counts(k) for k in LANGUAGES])))


def references(histograms: DataFrame) -> dict[str, tuple]:
    """Class and common-word sums of every declared language, over all its documents."""
    n = len(COMMON_WORDS["en"]) + 1
    sums = [F.sum(F.col("_classes")[i]).alias(f"c{i}") for i in range(len(CLASSES))]
    sums += [F.sum(F.col("_common")[0][i]).alias(f"w{i}") for i in range(n)]
    found = {}
    for row in histograms.filter(F.col("_lang").isin(*LANGUAGES)).groupBy("_lang").agg(*sums).collect():
        classes, common = ([row[f"{x}{i}"] or 0 for i in range(m)] for x, m in (("c", len(CLASSES)), ("w", n)))
        if sum(classes) and sum(common):
            found[row["_lang"]] = (classes, common)
    return found


def js_distance(p: Column, q: Column) -> Column:
    """Jensen-Shannon distance of two arrays of counts; null where one of them is all zero."""
    def part(a: Column, b: Column) -> Column:
        # a * log2(a / ((a + b) / 2)), 0 where a is 0
        return F.when(a > 0, a * F.log2(2 * a / (a + b))).otherwise(F.lit(0.0))

    def total(x: Column) -> Column:
        return F.aggregate(x, F.lit(0.0), lambda s, v: s + v.cast("double"))

    def distance(a: Column, b: Column) -> Column:
        return let(
            F.struct(total(a).alias("a"), total(b).alias("b")),
            lambda n: F.when(
                (n["a"] > 0) & (n["b"] > 0),
                F.sqrt(F.greatest(F.lit(0.0), 0.5 * F.aggregate(
                    F.zip_with(a, b, lambda x, y: part(x / n["a"], y / n["b"])
                               + part(y / n["b"], x / n["a"])),
                    F.lit(0.0), lambda s, v: s + v,
                ))),
            ),
        )

    return let(F.struct(p.alias("p"), q.alias("q")), lambda s: distance(s["p"], s["q"]))


def _to_reference(found: dict[str, tuple], which: int, counts: dict[str, Column],
                  own: Column) -> Column:
    """Distance to the document's language, or to the nearest where that is not declared."""
    if not found:
        return F.lit(None).cast("double")
    literal = {k: F.array(*[F.lit(int(x)) for x in v[which]]) for k, v in sorted(found.items())}
    each = [js_distance(counts[k], literal[k]) for k in literal]
    nearest = F.least(*each) if len(each) > 1 else each[0]
    return _by_language({k: js_distance(own, v) for k, v in literal.items()}, nearest)


def _covered(hashes: str) -> Column:
    """Words inside windows that occur twice or more, from the hash of the window at each word."""
    pairs = F.sort_array(F.zip_with(
        hashes, F.sequence(F.lit(1), F.size(hashes)),
        lambda h, i: F.struct(h.alias("h"), i.alias("i")),
    ))

    def flagged(p: Column) -> Column:
        same_next = F.zip_with(
            p, F.slice(p, F.lit(2), F.size(p)), lambda a, b: F.coalesce(a["h"] == b["h"], F.lit(False))
        )
        return let(same_next, lambda n: F.zip_with(
            p,
            F.zip_with(n, F.concat(F.array(F.lit(False)), n), lambda x, y: F.coalesce(x, F.lit(False)) | y),
            lambda a, f: F.when(f, a["i"]),
        ))

    def span(q: Column) -> Column:
        steps = F.zip_with(q, F.slice(q, F.lit(2), F.size(q)), lambda a, b: F.least(F.lit(WINDOW), b - a))
        return F.aggregate(steps, F.lit(0), lambda s, v: s + v)

    return let(let(pairs, flagged), lambda f: let(F.sort_array(F.array_compact(f)), span))


def with_figures(docs: DataFrame, text: str = "text", lang: str = "lang") -> DataFrame:
    """Adds histograms and base figures. Windows are compared by 64-bit hashes of their words."""
    df = with_histograms(docs, text, lang).withColumn("_h", F.transform("_words", lambda w: F.xxhash64(w)))
    for step in (1, 2, 4):  # hashes of 2, 4 and 8 words
        df = df.withColumn("_h", F.zip_with(
            "_h", F.slice("_h", F.lit(step + 1), F.size("_h")), lambda a, b: F.xxhash64(a, b)
        ))
    full = F.greatest(F.size("_h") - (WINDOW - 1), F.lit(0))
    df = df.withColumn("_h", F.slice("_h", F.lit(1), full))
    lines = F.filter(F.split("_text", "\n"), lambda x: F.regexp_like(x, F.lit(r"[^\x20\x09-\x0D]")))
    return df.withColumn("_lines", lines).withColumns({
        "word_chars": _length("_text") - F.col("_classes")[CLASSES.index("space")],
        "n_symbols": F.col("_classes")[CLASSES.index("symbol")],
        "n_dup_lines": (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long"),
        "n_repeat_words": F.when(
            F.size(F.array_distinct("_h")) < F.size("_h"), _covered("_h")
        ).otherwise(F.lit(0)).cast("long"),
    })


def judged(figures: DataFrame, found: dict[str, tuple]) -> DataFrame:
    classes, common = F.col("_classes"), F.col("_common")
    df = figures.withColumns({
        "class_distance": _to_reference(found, 0, dict.fromkeys(LANGUAGES, classes), classes),
        "word_distance": _to_reference(
            found, 1, {k: common[i] for i, k in enumerate(LANGUAGES)}, common[0]),
        "base_failed": (F.col("n_words") < MIN_BASE_WORDS)
        | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words")),
        "_judged": (F.col("n_words") >= MIN_WORDS) & (classes[0] + classes[1] >= MIN_LETTERS),
    })
    far = (F.coalesce("class_distance", F.lit(0.0)) > MAX_CLASS_DISTANCE) | (
        F.coalesce("word_distance", F.lit(0.0))
        > WORD_DISTANCE + WORD_DISTANCE_SPREAD / F.sqrt(F.col("n_words"))
    )
    return df.withColumn("kept", ~F.col("base_failed") & ~(F.col("_judged") & far))


def quality_report(docs: DataFrame, key: str = "doc_id", text: str = "text",
                   lang: str = "lang") -> DataFrame:
    """One row per document: figures, distances and verdict.

    The figures, a few numbers per document, are written to the shared folder,
    so the texts are read once for both the references and the verdicts.
    """
    taken = only(docs, *dict.fromkeys((key, text, lang))).withColumn("_key", F.col(f"`{key}`"))
    figures = written(with_figures(taken, text, lang).select(
        "_key", "_lang", "_classes", "_common", *BASE), "quality-figures")
    return judged(figures, references(figures)).select(
        F.col("_key").alias(key), *BASE, "base_failed", "kept", "class_distance", "word_distance",
    )


def keep_good(docs: DataFrame, text: str = "text", lang: str = "lang") -> DataFrame:
    """The documents the rules keep, all their columns as they were.

    Writing the texts would cost more than reading them again, so they are read twice.
    """
    found = references(with_histograms(only(docs, *dict.fromkeys((text, lang))), text, lang))
    columns = [F.col(f"`{c}`") for c in docs.columns]
    packed = docs.select(F.col(f"`{text}`").alias("_t"), F.col(f"`{lang}`").alias("_l"),
                         F.struct(*columns).alias("_row"))
    # A filter would be moved below the figures, which it would then compute once more in every
    # place that names them. It cannot pass a column that is not deterministic.
    df = judged(with_figures(packed, "_t", "_l"), found).withColumn("_at", F.monotonically_increasing_id())
    return df.filter(F.col("kept") & (F.col("_at") >= 0)).select("_row.*")
