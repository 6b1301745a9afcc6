"""Quality rules by distribution divergence, in DataFrame functions only.

Base rules count words, symbols, repeated lines and repeated three-word windows. A text that passes them is held
against its language: the histogram of its character classes, and the histogram of its language's commonest words,
each by Jensen-Shannon distance (base 2, from 0 to 1) to that language's reference, gathered over all texts. A short
text's histogram strays by chance, by about one over the root of its length; the word limit allows for that, and
below a minimum length no verdict is passed.

Scale. The references take one aggregate over (language, word) with map-side combining; a language's commonest words
are picked among those that make up at least ``MIN_SHARE`` of its words, at most ``1 / MIN_SHARE`` of them, so no
window sees a whole vocabulary. References are a row per language; they are broadcast while they are at most
``BROADCAST_LANGS`` rows, and joined by shuffle beyond. Texts are never shuffled, then.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from meridia.llm.common import checkpointed, table

MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
COMMON_WORDS = 32
MIN_SHARE = 0.002
#: The distance of character classes may be so large.
CHAR_LIMIT = 0.30
#: The distance of common words may be WORD_LIMIT + WORD_SLACK / sqrt(words).
WORD_LIMIT, WORD_SLACK = 0.10, 2.6
#: A language needs so many words in all for a reference.
MIN_REFERENCE = 2000
BROADCAST_LANGS = 2000
CLASSES = ("upper", "letter", "digit", "point", "other")
SYMBOLS = "#*$%&|<>"
#: An array has fewer places than two to this power.
PLACE_BITS = 31
POINTS = ".,;:!?'\"()-"


def split_words(text: Column) -> Column:
    return F.array_remove(F.split(text, r"[\x20\x09-\x0D]+"), "")


def without_letters(text: Column) -> Column:
    return F.regexp_replace(text, r"\p{L}+", "")


def class_counts(text: Column, no_letters: Column) -> dict[str, Column]:
    """Code points of each class; ``text`` is without white space, ``no_letters`` is what ``without_letters`` leaves."""
    upper = F.char_length(text) - F.char_length(F.regexp_replace(text, r"\p{Lu}+", ""))
    letters = F.char_length(text) - F.char_length(no_letters)
    digits = F.char_length(no_letters) - F.char_length(F.regexp_replace(no_letters, r"\p{N}+", ""))
    points = F.char_length(no_letters) - F.char_length(F.translate(no_letters, POINTS, ""))
    rest = F.char_length(no_letters) - digits - points
    return {k: v.cast("long") for k, v in zip(CLASSES, (upper, letters - upper, digits, points, rest))}


def references(docs: DataFrame, text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """(ref_lang, ref_words array<string>, ref_word_p array<double>, ref_class_p array<double>): a row per language.

    Over all texts. ``ref_word_p`` has the shares of ``ref_words`` and, last, of all other words. A language with under
    ``MIN_REFERENCE`` words has none. A null language counts as the empty one.
    """
    words = docs.select(F.coalesce(F.col(f"`{lang_col}`"), F.lit("")).alias("ref_lang"), F.explode(split_words(F.coalesce(F.col(f"`{text_col}`"), F.lit("")))).alias("word"))
    vocabulary = checkpointed(words.groupBy("ref_lang", "word").agg(F.count("*").alias("n")))
    classes = vocabulary.select("ref_lang", "n", *[(c * F.col("n")).alias(k) for k, c in class_counts(F.col("word"), without_letters(F.col("word"))).items()])
    totals = classes.groupBy("ref_lang").agg(F.sum("n").alias("total"), *[F.sum(k).alias(k) for k in CLASSES]).where(F.col("total") >= MIN_REFERENCE)
    chars = sum((F.col(k) for k in CLASSES[1:]), F.col(CLASSES[0]))
    totals = totals.select("ref_lang", "total", F.array(*[F.col(k) / chars for k in CLASSES]).alias("ref_class_p"))
    lower = vocabulary.groupBy("ref_lang", F.lower("word").alias("word")).agg(F.sum("n").alias("n"))
    totals = checkpointed(totals)
    common = lower.join(_small(totals.select("ref_lang", "total")), "ref_lang").where(F.col("n") >= F.lit(MIN_SHARE) * F.col("total"))
    ranked = common.withColumn("rank", F.row_number().over(W.partitionBy("ref_lang").orderBy(F.desc("n"), "word"))).where(F.col("rank") <= COMMON_WORDS)
    tops = ranked.groupBy("ref_lang").agg(F.array_sort(F.collect_list(F.struct("rank", "word", "n"))).alias("top"), F.sum("n").alias("seen"))
    both = totals.join(tops, "ref_lang", "left").withColumn("seen", F.coalesce("seen", F.lit(0)))
    top = F.coalesce("top", F.array().cast("array<struct<rank:int,word:string,n:bigint>>"))
    shares = F.concat(F.transform(top, lambda x: x["n"] / F.col("total")), F.array((F.col("total") - F.col("seen")) / F.col("total")))
    return both.select("ref_lang", F.transform(top, lambda x: x["word"]).alias("ref_words"), shares.alias("ref_word_p"), "ref_class_p")


def _small(refs: DataFrame) -> DataFrame:
    """A checkpointed row per language, marked for broadcast while there are at most ``BROADCAST_LANGS``."""
    return refs if refs.limit(BROADCAST_LANGS + 1).count() > BROADCAST_LANGS else F.broadcast(refs)


def js_distance(p: Column, q: Column) -> Column:
    """Root of the Jensen-Shannon divergence (base 2) of two arrays of shares."""
    part = lambda x, m: F.when(x > 0, x * F.log2(x / m)).otherwise(F.lit(0.0))
    terms = F.zip_with(p, q, lambda x, y: part(x, (x + y) / 2) + part(y, (x + y) / 2))
    return F.sqrt(F.greatest(F.lit(0.0), F.aggregate(terms, F.lit(0.0), lambda a, x: a + x) / 2))


def _repeats(found: DataFrame) -> DataFrame:
    """n_repeat_words: the words in three-word windows that occur twice or more.

    Windows are compared by XXH64 within one text. Only texts with an equal pair are sorted; the places of
    their repeated windows, in order, give how many words they cover, without a look-up per word.
    """
    # the last two places hold a two-word and a one-word window, which equal no other
    found = found.withColumn("t", F.transform("w", lambda x, i: F.xxhash64(x, F.get("w", i + 1), F.get("w", i + 2))))
    # high bits of the hash above the place: primitive longs sort fast, and neighbours with equal high bits are few
    high = lambda x: F.shiftrightunsigned(x, PLACE_BITS)
    packed = F.sort_array(F.transform("t", lambda h, i: F.shiftleft(high(h), PLACE_BITS).bitwiseOR(i.cast("long"))))
    found = found.withColumn("s", F.when(F.size(F.array_distinct("t")) < F.size("t"), packed).otherwise(F.array().cast("array<bigint>")))
    near = F.filter("s", lambda x, k: high(F.get("s", k - 1)).eqNullSafe(high(x)) | high(F.get("s", k + 1)).eqNullSafe(high(x)))
    place = lambda x: x.bitwiseAND(F.lit((1 << PLACE_BITS) - 1)).cast("int")
    found = found.withColumn("s", F.array_sort(F.transform(near, lambda x: F.struct(F.get("t", place(x)).alias("h"), place(x).alias("i")))))
    same = F.filter("s", lambda x, k: F.get("s", k - 1)["h"].eqNullSafe(x["h"]) | F.get("s", k + 1)["h"].eqNullSafe(x["h"]))
    found = found.withColumn("at", F.when(F.size("s") > 0, F.sort_array(F.transform(same, lambda x: x["i"]))).otherwise(F.array().cast("array<int>")))
    steps = F.zip_with("at", F.expr("slice(at, 2, greatest(size(at), 1))"), lambda a, b: F.when(a.isNull(), F.lit(0)).otherwise(F.least(F.lit(3), F.coalesce(b - a, F.lit(3)))))
    return found.withColumn("n_repeat_words", F.aggregate(steps, F.lit(0).cast("long"), lambda s, x: s + x)).drop("t", "s", "at")


def judge(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", refs: DataFrame | None = None) -> DataFrame:
    """(row, quality): each row of ``docs`` as a struct; the base counts, base_failed, both distances and kept as another.

    Null text: no words, which fails the base. Distances are null where the base failed or the language has no
    reference; such a text keeps the base's verdict. A language that has words enough, but none that is common, is judged by
    character classes alone. Equal rows are judged alike; no rows give no rows. Columns of ``docs`` may have any names.
    """
    refs = references(docs, text_col, lang_col) if refs is None else refs
    refs = checkpointed(refs)
    inner = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("text"), F.coalesce(F.col(f"`{lang_col}`"), F.lit("")).alias("ref_lang"))
    inner = inner.join(_small(refs), "ref_lang", "left")
    inner = inner.withColumn("w", split_words(F.col("text")))
    inner = inner.withColumn("squeezed", F.array_join("w", "")).withColumn("bare", without_letters(F.col("squeezed")))
    inner = inner.withColumn("n_words", F.size("w").cast("long")).withColumn("word_chars", F.char_length("squeezed").cast("long"))
    inner = inner.withColumn("n_symbols", (F.char_length("bare") - F.char_length(F.translate("bare", SYMBOLS, ""))).cast("long"))
    inner = inner.withColumn("lines", F.filter(F.split("text", "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]")))
    inner = inner.withColumn("n_dup_lines", (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long")).drop("lines")
    inner = _repeats(inner).withColumn("base_failed", (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words")))
    judged = ~F.col("base_failed") & F.col("ref_words").isNotNull()
    counts = class_counts(F.col("squeezed"), F.col("bare"))
    inner = inner.withColumn("c", F.when(judged, F.array(*[counts[k] / F.col("word_chars") for k in CLASSES])))
    inner = inner.withColumn("hits", F.when(judged, F.filter(split_words(F.lower("text")), lambda x: F.array_contains(F.col("ref_words"), x))))
    inner = inner.withColumn("seen", F.transform("ref_words", lambda r: F.size("hits") - F.size(F.array_remove(F.col("hits"), r))))
    inner = inner.withColumn("p", F.concat(F.transform("seen", lambda x: x / F.col("n_words")), F.array((F.col("n_words") - F.size("hits")) / F.col("n_words"))))
    inner = inner.withColumn("char_distance", F.when(judged, js_distance(F.col("c"), F.col("ref_class_p")))).withColumn("word_distance", F.when(judged, js_distance(F.col("p"), F.col("ref_word_p"))))
    fits = (F.col("char_distance") <= CHAR_LIMIT) & (F.col("word_distance") <= WORD_LIMIT + WORD_SLACK / F.sqrt("n_words"))
    inner = inner.withColumn("kept", ~F.col("base_failed") & F.coalesce(fits, F.lit(True)))
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "char_distance", "word_distance", "kept"]
    # a row for each element of a one-element array: a filter on the verdict then stays above, and repeats no expression
    return inner.select("row", F.explode(F.array(F.struct(*names))).alias("quality"))


def op5_quality(spark, sf_dir: str) -> DataFrame:
    """Contract of op5 over all of ``documents``."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    done = judge(docs)
    return done.select("row.doc_id", *[F.col(f"quality.{c}").alias(c) for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")])


OP5_SQL = rf"""
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS text, coalesce(lang, '') AS lang,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w,
         regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', '', 'g') AS sq
  FROM documents),
voc AS (SELECT lang, word, count(*) AS n FROM (SELECT lang, unnest(w) AS word FROM d) GROUP BY 1, 2),
cls AS (
  SELECT lang, sum(n) AS total,
    sum(n * length(regexp_replace(word, '[^\p{{Lu}}]', '', 'g'))) AS upper,
    sum(n * length(regexp_replace(word, '[^\p{{L}}]', '', 'g'))) AS letters,
    sum(n * length(regexp_replace(word, '[^\p{{N}}]', '', 'g'))) AS digit,
    sum(n * length(regexp_replace(word, '[^.,;:!?''"()\-]', '', 'g'))) AS point,
    sum(n * length(word)) AS chars
  FROM voc GROUP BY 1 HAVING sum(n) >= {MIN_REFERENCE}),
low AS (SELECT lang, lower(word) AS word, sum(n) AS n FROM voc GROUP BY 1, 2),
ranked AS (
  SELECT low.lang, word, low.n, row_number() OVER (PARTITION BY low.lang ORDER BY low.n DESC, word) AS rank, total
  FROM low JOIN cls ON low.lang = cls.lang WHERE low.n >= {MIN_SHARE}e0 * total),
top AS (
  SELECT lang, list(word ORDER BY rank) AS rw, list(n::DOUBLE / total ORDER BY rank) AS rp0, (any_value(total) - sum(n))::DOUBLE / any_value(total) AS rest
  FROM ranked WHERE rank <= {COMMON_WORDS} GROUP BY 1),
refs AS (
  SELECT cls.lang, coalesce(rw, []) AS rw, list_append(coalesce(rp0, []), coalesce(rest, 1e0)) AS rp,
    [upper::DOUBLE / chars, (letters - upper)::DOUBLE / chars, digit::DOUBLE / chars, point::DOUBLE / chars, (chars - letters - digit - point)::DOUBLE / chars] AS rc
  FROM cls LEFT JOIN top ON top.lang = cls.lang),
tri AS (
  SELECT rid, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS t
  FROM (SELECT rid, w, unnest(range(1, len(w) - 1)) AS i FROM d WHERE len(w) >= 3)),
rep AS (
  SELECT rid, count(DISTINCT p) AS n FROM (
    SELECT rid, unnest([i, i + 1, i + 2]) AS p FROM (SELECT rid, i, count(*) OVER (PARTITION BY rid, t) AS c FROM tri) WHERE c > 1) GROUP BY 1),
f AS (
  SELECT d.rid, doc_id, d.lang, sq, w, len(w)::BIGINT AS n_words, length(sq)::BIGINT AS word_chars,
    length(regexp_replace(sq, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols,
    (len(list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')))
      - len(list_distinct(list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')))))::BIGINT AS n_dup_lines,
    coalesce(rep.n, 0)::BIGINT AS n_repeat_words
  FROM d LEFT JOIN rep ON d.rid = rep.rid),
b AS (SELECT *, (n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MAX_REPEAT_PERCENT} * n_words) AS base_failed FROM f),
h AS (
  SELECT b.*, rc, rp,
    [length(regexp_replace(sq, '[^\p{{Lu}}]', '', 'g'))::DOUBLE / word_chars,
     (length(regexp_replace(sq, '[^\p{{L}}]', '', 'g')) - length(regexp_replace(sq, '[^\p{{Lu}}]', '', 'g')))::DOUBLE / word_chars,
     length(regexp_replace(sq, '[^\p{{N}}]', '', 'g'))::DOUBLE / word_chars,
     length(regexp_replace(sq, '[^.,;:!?''"()\-]', '', 'g'))::DOUBLE / word_chars,
     length(regexp_replace(sq, '[\p{{L}}\p{{N}}.,;:!?''"()\-]', '', 'g'))::DOUBLE / word_chars] AS c,
    list_transform(rw, lambda r: len(list_filter(w, lambda x: lower(x) = r))) AS seen
  FROM b LEFT JOIN refs ON b.lang = refs.lang AND NOT base_failed),
p AS (SELECT *, list_append(list_transform(seen, lambda x: x::DOUBLE / n_words), (n_words - coalesce(list_sum(seen), 0))::DOUBLE / n_words) AS p FROM h),
j AS (
  SELECT *,
    sqrt(greatest(0.0, list_sum(list_transform(range(1, 6), lambda i:
      CASE WHEN c[i] > 0 THEN c[i] * log2(c[i] / ((c[i] + rc[i]) / 2)) ELSE 0 END + CASE WHEN rc[i] > 0 THEN rc[i] * log2(rc[i] / ((c[i] + rc[i]) / 2)) ELSE 0 END)) / 2)) AS cd,
    sqrt(greatest(0.0, list_sum(list_transform(range(1, len(p) + 1), lambda i:
      CASE WHEN p[i] > 0 THEN p[i] * log2(p[i] / ((p[i] + rp[i]) / 2)) ELSE 0 END + CASE WHEN rp[i] > 0 THEN rp[i] * log2(rp[i] / ((p[i] + rp[i]) / 2)) ELSE 0 END)) / 2)) AS wd
  FROM p)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  (NOT base_failed AND (rp IS NULL OR (cd <= {CHAR_LIMIT}e0 AND wd <= {WORD_LIMIT}e0 + {WORD_SLACK}e0 / sqrt(n_words)))) AS kept
FROM j
"""
