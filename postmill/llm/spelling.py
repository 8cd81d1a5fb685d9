"""Spelling variants by errata-trie merging.

The trie of all words is a table: a node is a prefix, and each position of a word is an edge out of the node before it, its
end one too. The child with the most words below it is a node's heavy one, the others are light, and so is a word's end
where longer words go on. A light subtree is merged into its siblings with one character skipped or replaced, the small
into the large: each of its words is moved to where it would end with the heavy character for its own, without its own,
or with the heavy one before its own; light siblings meet with that character left open. What comes to lie on the end of
another word is one edit away from it. A word lies in no more light subtrees than the logarithm of the number of words,
so that many words are moved for each, not one for each position.

Two words at one edit part at a node. If one of them goes on by the heavy edge, the other one is light there and is
moved onto it; if both are light, they meet with that character left open, and as there are only as many of these as
letters, no group is large. Nodes are told apart by a hash; two that share one share a heavy edge, which costs moves but
loses no pair, and ends are compared as strings.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from postmill.llm.common import cut_table, drop_table

#: Code points and occurrences of a word, and how many times as frequent its form is.
LEAST_LENGTH, LEAST_COUNT, TIMES = 7, 2, 10
#: One in so many runs loses a code point.
NOISE = 31
#: Edges this near the root belong to many words; each is dealt to so many keys.
SHALLOW, SALTS = 3, 16
#: No letter: what follows a word's last character, and what stands for any character.
END = OPEN = "\x00"
#: Characters of a word that are hashed together.
PIECE = 64
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def count_words(docs: DataFrame, text: str = "text", key: str = "doc_id", least_length: int = LEAST_LENGTH, least_count: int = LEAST_COUNT) -> DataFrame:
    """(word, n) of all texts. A run shorter than a word makes none, so it is passed over.

    A run goes on without the code point that the checksum of key and run picks, where it picks one.
    """
    found = F.regexp_extract_all(F.col(text), F.lit(f"([A-Za-zÀ-ÿ]{{{least_length},}})"), F.lit(1))
    lowered = F.transform(found, lambda run: F.translate(run, UPPER, LOWER))
    prefix = F.concat(F.coalesce(F.col(key).cast("string"), F.lit("")), F.lit(":"))
    # checksums are taken before the rows are made, so that no expression holds another one many times
    runs = docs.select(F.explode(F.transform(lowered, lambda run: F.struct(run.alias("run"), F.crc32(F.concat(prefix, run)).alias("h")))).alias("r")).select("r.*")
    at = (F.col("h") % F.length("run")).cast("int")
    rest = F.concat(F.substring("run", F.lit(1), at), F.substring(F.col("run"), at + 2, F.length("run")))
    words = runs.where((F.length("run") > least_length) | ((F.length("run") == least_length) & (F.col("h") % NOISE != 0))).select(F.when(F.col("h") % NOISE == 0, rest).otherwise(F.col("run")).alias("word"))
    return words.groupBy("word").agg(F.count("*").alias("n")).where(F.col("n") >= least_count)


def edges(words: DataFrame) -> DataFrame:
    """Of each word, under a hash of it, the edges on its way: the node that it leaves, the depth and the character, END at last.

    A node's hash is one of the whole pieces before it and of the characters after these, so that long words take little.
    """

    def of_piece(before: Column, piece: Column, n: Column) -> Column:
        def edge(k: Column) -> Column:
            return F.struct(F.xxhash64(before, F.substring(piece, F.lit(1), k)).alias("node"), (n * PIECE + k).alias("depth"), F.substring(piece, k + 1, F.lit(1)).alias("c"))

        return F.transform(F.sequence(F.lit(0), F.length(piece) - 1), edge)

    pieces = F.regexp_extract_all(F.concat("word", F.lit(END)), F.lit(f"(?s)(.{{1,{PIECE}}})"), F.lit(1))
    # an array of one, bound by a lambda, so that pieces are cut once
    way = F.transform(F.array(pieces), lambda all_: F.flatten(F.transform(all_, lambda piece, n: of_piece(F.xxhash64(F.slice(all_, F.lit(1), n)), piece, n))))[0]
    return words.select(F.xxhash64("word").alias("id"), F.explode(way).alias("e")).select("id", "e.*")


def near_words(words: DataFrame) -> DataFrame:
    """All ordered pairs (word, near) among distinct words that differ by one inserted, deleted or replaced code point."""
    way = cut_table(edges(words))
    children = way.groupBy("node", "depth", "c").agg(F.count("*").alias("size"))
    most = F.max(F.when(F.col("c") != END, F.struct("size", "c"))).over(Window.partitionBy("node", "depth"))
    light = children.withColumn("heavy", most["c"]).where("c <> heavy")  # a node with an end alone has no heavy child
    salts = F.when(F.col("depth") < SHALLOW, SALTS).otherwise(1)
    light = light.withColumn("salt", F.explode(F.sequence(F.lit(0), salts - 1)))
    below = way.withColumn("salt", F.pmod("id", salts).cast("int")).join(light, ["node", "depth", "c", "salt"]).select("id", "depth", "heavy")
    named = words.select(F.xxhash64("word").alias("id"), "word")
    own = F.substring(F.col("word"), F.col("depth") + 1, F.lit(1))
    before, after = F.substring(F.col("word"), F.lit(1), F.col("depth")), F.substring(F.col("word"), F.col("depth") + 2, F.length("word"))
    moved = cut_table(named.join(below, "id").select("word", "heavy", own.alias("own"), before.alias("before"), after.alias("after")))
    drop_table(way)

    ends = F.array(F.concat("before", "heavy", "after"), F.concat("before", "after"), F.concat("before", "heavy", "own", "after"))
    onto = moved.select("word", F.explode(F.array_distinct(ends)).alias("near")).where("word <> near").join(words.select(F.col("word").alias("near")), "near", "left_semi")
    siblings = moved.where("own <> ''").groupBy(F.concat("before", F.lit(OPEN), "after").alias("left_open")).agg(F.collect_set("word").alias("all")).where(F.size("all") > 1)
    among = siblings.select(F.explode("all").alias("word"), "all").select("word", F.explode("all").alias("near")).where("word <> near")
    found = cut_table(onto.select("word", "near").union(onto.select("near", "word")).union(among).distinct())
    drop_table(moved)
    return found


def rooted(forms: DataFrame) -> DataFrame:
    """(word, root) of words with a form: where following forms ends. Steps double, and a form is TIMES as frequent, so a few rounds do."""
    steps = cut_table(forms.select("word", F.col("form").alias("root")))
    while True:
        further = steps.select(F.col("word").alias("root"), F.col("root").alias("next"))
        went = cut_table(steps.join(further, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")))
        drop_table(steps)
        steps = went
        if steps.where("moved").isEmpty():
            return steps.select("word", "root")


def spelling_variants(docs: DataFrame, text: str = "text", key: str = "doc_id", least_length: int = LEAST_LENGTH, least_count: int = LEAST_COUNT, times: int = TIMES) -> DataFrame:
    """Of each word of the texts: word, form, root, n, n_near, form_n.

    Words are the runs of Latin letters with A to Z lower-cased, of which one in NOISE loses a code point, chosen by key
    and run; those of `least_length` code points and `least_count` occurrences count. form is the near word of largest n
    (the least of equal ones) if that is `times` its own n, else null; root follows forms to the last. Null and empty
    texts have no words, each row of a repeated key counts, and a null key is an empty one. No words, no rows.
    """
    words = cut_table(count_words(docs, text, key, least_length, least_count))
    pairs = near_words(words.select("word"))
    counts = words.select(F.col("word").alias("near"), F.col("n").alias("near_n"))
    best = F.min(F.struct((-F.col("near_n")).alias("minus"), "near"))
    near = pairs.join(counts, "near").groupBy("word").agg(F.count("*").alias("n_near"), best.alias("best"))
    judged = words.join(near, "word", "left").withColumn("good", -F.col("best.minus") >= times * F.col("n"))
    judged = cut_table(judged.select("word", F.when(F.col("good"), F.col("best.near")).alias("form"), "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), F.when(F.col("good"), -F.col("best.minus")).alias("form_n")))
    drop_table(words)
    drop_table(pairs)
    roots = rooted(judged.where("form IS NOT NULL"))
    return judged.join(roots, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
