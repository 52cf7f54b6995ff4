"""Spelling variants: words one edit apart, found by asymmetric chunks, and the form each of them leads to.

A word as chunk side is cut into two disjoint chunks. One edit leaves one of them whole, so it is a gram of the other
word, at the same place or, behind an inserted or deleted character, shifted by one. The other word, as gram side,
gives its grams at those places for every length a longer or equally long partner can have, and both sides meet by
(length of the partner, which chunk, text). What meets is verified inside the join.

A chunk that many words share ("tion" at the end) would bring all of them together. Such keys are counted and replaced by
narrower ones: the other chunk, in which the edit lies, is cut in two again, and the half that is whole joins the key.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowmill.functions.columns import q
from flowmill.llm import sql
from flowmill.session import materialize, new_path, scratch

#: Maximal runs of letters.
RUN = r"[A-Za-zÀ-ÿ]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Words are runs of so many code points that occur so often.
LEAST_LENGTH, LEAST_COUNT = 5, 3
#: A word's form occurs at least so many times as often.
FORM_FACTOR = 2
#: One run in so many, by the checksum of its document and text, loses a code point.
SLIP = 97
#: Words on the chunk side from which on a key is replaced by narrower ones.
HOT_KEY = 64
#: Keys (8 bytes each) that may be broadcast; more are joined by a shuffle.
BROADCAST_KEYS = 1_000_000


def slipped(run: Column, doc_id: Column) -> Column:
    """The run, without one of its code points where the checksum of ``<doc_id>:<run>`` says so; a null id is empty."""
    h = F.crc32(F.concat(F.coalesce(doc_id.cast("string"), F.lit("")), F.lit(":"), run).cast("binary"))
    at = (h % F.length(run)).cast("int")
    cut = F.concat(F.substring(run, F.lit(1), at), F.substring(run, at + 2, F.length(run)))
    return F.when(h % SLIP == 0, cut).otherwise(run)


def count_words(
    docs: DataFrame,
    text: str = "text",
    id: str = "doc_id",
    slips: bool = False,
    least_length: int = LEAST_LENGTH,
    least_count: int = LEAST_COUNT,
) -> DataFrame:
    """(word, n): the runs of letters in all texts, A-Z in lower case, of a least length and a least count.

    With ``slips`` one run in 97 loses a code point first (see ``slipped``). Null and empty texts have no runs.
    """
    runs = docs.select(q(id).alias("id"), F.explode(F.regexp_extract_all(q(text).cast("string"), F.lit(RUN), F.lit(0))).alias("run"))
    runs = runs.filter(F.length("run") >= least_length)  # no run gets longer
    low = F.when(F.col("run").rlike("[A-Z]"), F.translate("run", UPPER, LOWER)).otherwise(F.col("run"))
    runs = runs.select("id", low.alias("run"))
    word = slipped(F.col("run"), F.col("id")) if slips else F.col("run")
    words = runs.select(word.alias("word")).filter(F.length("word") >= least_length)
    return words.groupBy("word").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= least_count)


def _without(word: Column, length: Column, borders: Sequence[Column], part: int, partner: Column) -> tuple[Column, Column]:
    """What is left of a word when the part between two borders, given for the partner's length, is left out."""
    front = F.substring(word, F.lit(1), borders[part])
    behind = partner - borders[part + 1]
    return front, F.substring(word, length - behind + 1, behind)


def _borders(partner: Column) -> list[Column]:
    """The chunk side's word in four: the middle border parts the two chunks, the others part each chunk."""
    half = F.floor(partner / 2).cast("int")
    return [F.lit(0), F.floor(half / 2).cast("int"), half, (half + F.floor((partner - half) / 2)).cast("int"), partner]


def _keys(words: DataFrame, side: str) -> DataFrame:
    """A row per word, partner's length and whole chunk (0 first, 1 second): its key and the two narrower ones."""
    lengths = [F.col("length")] if side == "chunk" else [F.col("length"), F.col("length") + 1]
    words = words.withColumn("partner", F.explode(F.array(*lengths)))
    partner, word, length = F.col("partner"), F.col("word"), F.col("length")
    four = _borders(partner)
    two = [four[0], four[2], four[4]]
    found = []
    for whole, damaged in ((0, 1), (1, 0)):
        key = F.xxhash64(partner, F.lit(whole), *_without(word, length, two, damaged, partner))
        narrow = [F.xxhash64(partner, F.lit(2 + part), *_without(word, length, four, part, partner)) for part in (2 * damaged, 2 * damaged + 1)]
        found.append(F.struct(F.lit(whole).alias("whole"), key.alias("key"), *(x.alias(f"narrow{i}") for i, x in enumerate(narrow))))
    return words.select("word", "n", "length", "partner", F.explode(F.array(*found)).alias("k")).select(
        "word", "n", "length", "partner", "k.*"
    )


def _meet(chunks: DataFrame, grams: DataFrame, narrow: bool) -> DataFrame:
    """Pairs (a, b) that share a key and are one edit apart, each once."""
    left = chunks.select("key", "step", "whole", F.col("word").alias("a"), F.col("n").alias("a_n"), F.col("length").alias("a_length"))
    right = grams.select("key", F.col("word").alias("b"), F.col("n").alias("b_n"), F.col("length").alias("b_length"))
    a, b, partner, other = F.col("a"), F.col("b"), F.col("a_length"), F.col("b_length")
    four = _borders(partner)

    def same(borders: Sequence[Column], part: int) -> Column:
        mine, its = _without(a, partner, borders, part, partner), _without(b, other, borders, part, partner)
        return (mine[0] == its[0]) & (mine[1] == its[1])

    # a pair that two chunks bring together counts with the first
    first = (F.col("whole") == 0) | ~same([four[0], four[2], four[4]], 1)
    if narrow:
        again = F.when(F.col("whole") == 0, same(four, 2)).otherwise(same(four, 0))
        first = first & ((F.col("step") == 0) | ~again)
    near = ((partner > other) | (a < b)) & (F.levenshtein(a, b, 1) == 1) & first
    return left.join(right, "key").filter(near).select("a", "b", "a_n", "b_n")


def near_pairs(words: DataFrame) -> DataFrame:
    """Pairs (a, b, a_n, b_n) of ``words`` (word, n) that differ by one inserted, deleted or replaced code point."""
    words = words.withColumn("length", F.length("word"))
    chunks, grams = materialize(_keys(words, "chunk"), "chunks"), _keys(words, "gram")
    hot = chunks.groupBy("key").count().filter(F.col("count") > HOT_KEY).select("key")
    hot = materialize(hot, "hot")
    few = hot.count() <= BROADCAST_KEYS
    told = (F.broadcast(hot) if few else hot).withColumn("hot", F.lit(True))
    found = []
    for narrow in (False, True):
        sides = []
        for side in (chunks, grams):
            if not narrow:
                rest = side.join(told.drop("hot"), "key", "left_anti")
                sides.append(rest.withColumn("step", F.lit(0)))
            else:
                some = side.join(told.drop("hot"), "key", "left_semi").drop("key")
                steps = F.array(*(F.struct(F.lit(i).alias("step"), F.col(f"narrow{i}").alias("key")) for i in (0, 1)))
                sides.append(some.withColumn("s", F.explode(steps)).select("*", "s.*"))
        found.append(_meet(*sides, narrow))
    return found[0].unionByName(found[1])


def _roots(forms: DataFrame) -> DataFrame:
    """(word, root) for all words with a form: the word that following the forms ends with.

    A form occurs at least twice as often as its word, so a chain has at most about 60 words, and each round doubles the
    part of it that is known.
    """
    known = forms.select("word", F.col("form").alias("root"))
    while True:
        onward = known.select(F.col("word").alias("root"), F.col("root").alias("further"))
        known = materialize(
            known.join(onward, "root", "left").select("word", F.coalesce("further", "root").alias("root"), F.col("further").alias("moved")), "roots"
        )
        if known.filter("moved is not null").isEmpty():
            return known.select("word", "root")
        known = known.select("word", "root")


def variants(
    docs: DataFrame,
    text: str = "text",
    id: str = "doc_id",
    slips: bool = False,
    least_length: int = LEAST_LENGTH,
    least_count: int = LEAST_COUNT,
) -> DataFrame:
    """Per word: ``word``, ``n``, ``form``, ``form_n``, ``n_near`` and ``root``.

    ``n_near`` counts the words one edit apart, ``form`` is the one of them with the largest n (ties: the smallest in
    code-point order) if that is at least twice the word's, ``root`` the last word on the way from form to form. Null
    and empty texts give no words, repeated rows count again, a null id is empty, other columns are not looked at.
    ``least_length`` is 4 at least: shorter chunks could be empty.
    """
    if least_length < 4:
        raise ValueError("words of fewer than 4 code points have chunks without text")
    spark = docs.sparkSession
    path = new_path(spark, "variants")
    with scratch(spark):
        words = materialize(count_words(docs, text, id, slips, least_length, least_count), "words")
        pairs = near_pairs(words)
        ways = pairs.select(
            F.explode(
                F.array(
                    F.struct(F.col("a").alias("word"), F.col("b").alias("other"), F.col("b_n").alias("other_n")),
                    F.struct(F.col("b").alias("word"), F.col("a").alias("other"), F.col("a_n").alias("other_n")),
                )
            ).alias("w")
        ).select("w.*")
        best = ways.groupBy("word").agg(
            F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("other_n")).alias("minus_n"), F.col("other"))).alias("best")
        )
        joined = words.join(best, "word", "left")
        wins = -F.col("best.minus_n") >= FORM_FACTOR * F.col("n")
        formed = materialize(
            joined.select(
                "word",
                "n",
                F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
                F.when(wins, F.col("best.other")).alias("form"),
                F.when(wins, -F.col("best.minus_n")).alias("form_n"),
            ),
            "formed",
        )
        roots = _roots(formed.filter("form is not null"))
        out = formed.join(roots, "word", "left").select(
            "word", "n", "n_near", "form", "form_n", F.coalesce("root", "word").alias("root")
        )
        out.write.parquet(path)
    return spark.read.parquet(path)


def oracle() -> str:
    """The same over ``documents`` in DuckDB: words one edit apart share what is left without one character."""
    return f"""
    WITH RECURSIVE runs AS (
      SELECT d, translate(run, '{UPPER}', '{LOWER}') AS run, count(*) AS c FROM (
        SELECT coalesce(doc_id::VARCHAR, '') AS d, unnest(regexp_extract_all(text, '{RUN}')) AS run FROM documents)
      WHERE length(run) >= {LEAST_LENGTH} GROUP BY ALL),
    hashed AS (SELECT run, c, {sql.crc32("d || ':' || run")} AS h FROM runs),
    words AS MATERIALIZED (
      SELECT CASE WHEN h % {SLIP} = 0 THEN run[:(h % length(run))::INT] || run[(h % length(run))::INT + 2:] ELSE run END AS word,
        sum(c)::BIGINT AS n
      FROM hashed GROUP BY 1 HAVING length(word) >= {LEAST_LENGTH} AND sum(c) >= {LEAST_COUNT}),
    less AS MATERIALIZED (
      SELECT word, n, i, word[:i - 1] || word[i + 1:] AS rest FROM words, unnest(range(1, length(word) + 1)) AS t(i)),
    near AS MATERIALIZED (
      SELECT DISTINCT a.word, b.word AS other, b.n AS other_n
        FROM less a JOIN less b ON a.i = b.i AND a.rest = b.rest AND a.word <> b.word
      UNION SELECT l.word, w.word, w.n FROM less l JOIN words w ON l.rest = w.word
      UNION SELECT w.word, l.word, l.n FROM less l JOIN words w ON l.rest = w.word),
    best AS (
      SELECT word, count(*) AS n_near, first(other ORDER BY other_n DESC, other) AS other, max(other_n) AS other_n
      FROM near GROUP BY 1),
    formed AS MATERIALIZED (
      SELECT word, n, coalesce(n_near, 0) AS n_near, CASE WHEN other_n >= {FORM_FACTOR} * n THEN other END AS form,
        CASE WHEN other_n >= {FORM_FACTOR} * n THEN other_n END AS form_n
      FROM words LEFT JOIN best USING (word)),
    way AS (
      SELECT word, word AS at FROM formed
      UNION ALL SELECT way.word, f.form FROM way JOIN formed f ON f.word = way.at WHERE f.form IS NOT NULL)
    SELECT f.word, f.n, f.n_near, f.form, f.form_n, way.at AS root
    FROM formed f JOIN way ON way.word = f.word JOIN formed last ON last.word = way.at AND last.form IS NULL"""
