"""Line deduplication by an exact set-similarity join, in DataFrame operations.

A line's set is its distinct lower-cased words.  A line goes when an earlier
line has a set of Jaccard similarity 0.8 or more, whether or not that earlier line
stays itself.  Lines stand in the order of doc_id (null last), then the 64-bit hash
of the text, then line number: the order is total, also among rows that share a
doc_id or have none.

1. Lines with equal sets form a class (128-bit digest); its first line speaks
   for it, all others go.
2. The words of a class are ordered by rarity.  The rarity of a word is the
   count, over all texts, of the slot it hashes into (``SLOTS`` slots: what is
   sent to the executors does not grow with the data).  Any order that is the
   same for all lines keeps the join exact; a rare word first makes it fast.
3. Two sets of the required similarity share a word of their prefixes.  The join
   on prefix words applies the length filter, the positional filter and an
   overlap bound from 128-bit parity bitmaps: their Hamming distance never
   exceeds the symmetric difference of the sets.
4. Candidates are verified on their whole sets of 64-bit word hashes, fetched
   for the candidate lines alone.
5. The later class of a link loses its first line as well.  One link decides a
   class, so a group of many near copies never becomes all its pairs: each class
   is first compared with the earliest class of each of its min-hash groups, and
   the prefix join then looks for an earlier partner of the undecided ones only.

The words of a line are hashed once: what every later step needs of a line is
written in one table.

Defined results: null texts are empty; lines without words are never removed;
rows with equal doc_id and text are one document (also without a doc_id), rows
with one doc_id and different texts are several; null doc_ids come last; a text
that loses all its lines becomes empty; an empty table gives an empty one; only the
documented columns are read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import WORD, collect_garbage, text_or_empty
from tessera.session import cut_lineage, release

PERCENT = 80
SLOTS = 1 << 20
#: a class with more than this share of all lines is a common one
COMMON = 1 << 12
#: min-hash groups of a class
GROUPS = 4
#: the white space besides the blank
OTHER_SPACE = r"[\x09-\x0D]"


def blanks_only(text: Column) -> Column:
    """Lower-cased, with one kind of white space: Spark splits at a single
    character much faster than at a pattern."""
    low = F.lower(text)
    return F.when(low.rlike(OTHER_SPACE), F.regexp_replace(low, OTHER_SPACE, " ")).otherwise(low)


def words(line: Column) -> Column:
    """Distinct 64-bit hashes of a line's words, in ascending order."""
    hashes = F.transform(F.split(blanks_only(line), " "), lambda w: F.xxhash64(w))
    # the difference is distinct as well
    return F.sort_array(F.array_except(hashes, F.array(F.xxhash64(F.lit("")))))


def doc_number() -> Column:
    return F.coalesce(F.col("doc_id").cast("long"), F.lit(2**63 - 1))


def place() -> Column:
    """What orders lines: doc_id (null last), text, line number."""
    return F.struct(doc_number().alias("number"), F.col("doc_id").isNull().alias("unnumbered"), "text_key", "line_no")


def places(docs: DataFrame) -> DataFrame:
    """(doc_id, text_key, line_no, line) of every line with words."""
    text = text_or_empty()
    every = docs.select("doc_id", F.xxhash64(text).alias("text_key"), F.posexplode(F.split(text, "\n")).alias("line_no", "line"))
    return every.where(F.col("line").rlike(WORD))


def lines(docs: DataFrame) -> DataFrame:
    """``places`` with the set of each line instead of its text."""
    return places(docs).withColumn("words", words(F.col("line"))).drop("line")


def with_class(found: DataFrame) -> DataFrame:
    """``c1``, ``c2``: the digest of a line's set."""
    return found.withColumns({"c1": F.xxhash64("words"), "c2": F.xxhash64(F.lit(1), F.col("words"))})


def slot(word: Column) -> Column:
    return F.pmod(word, F.lit(SLOTS)).cast("int")


def word_levels(docs: DataFrame) -> Column:
    """Word occurrences over all texts by slot, in half powers of two above the
    57 bits that ``by_rarity`` adds, as an array of ``SLOTS`` numbers: a
    scalar subquery, which Spark evaluates once."""
    spark = docs.sparkSession
    text = F.replace(text_or_empty(), F.lit("\n"), F.lit(" "))
    every = docs.select(F.explode(F.split(blanks_only(text), " ")).alias("w")).where("w <> ''")
    counts = every.groupBy(word_slot(F.xxhash64("w")).alias("slot")).agg(F.count("*").alias("n"))
    none = spark.range(SLOTS).select(F.col("id").alias("slot"), F.lit(0).cast("long").alias("n"))
    whole = counts.unionByName(none).groupBy("slot").agg(F.sum("n").alias("n"))
    level = F.shiftleft(F.least(F.floor(F.log2(F.col("n") + 1) * 2), F.lit(63)).cast("long"), 57)
    # written: the subquery then only reads SLOTS rows
    whole = cut_lineage(whole.agg(F.transform(
        F.sort_array(F.collect_list(F.struct("slot", level.alias("level")))), lambda x: x["level"]).alias("levels")))
    return whole.select("levels").scalar()


def word_slot(word: Column) -> Column:
    """The highest bits of a word's hash."""
    return F.shiftrightunsigned(word, 64 - (SLOTS.bit_length() - 1))


def by_rarity(words_: Column, levels: Column) -> Column:
    """A number for each word, in ascending order: the level of its slot, then 57
    bits of its hash.  Words that share a number stand for each other in the
    join, which can only add candidates."""
    # the levels enter as a field of a one-element array, so that the inner
    # function can look at them without a copy for each row
    return F.sort_array(F.transform(F.array(F.struct(levels.alias("levels"), words_.alias("words"))), lambda s: F.transform(
        s["words"], lambda w: F.get(s["levels"], word_slot(w)).bitwiseOR(F.shiftrightunsigned(w, 7))))[0])


def parity(words_: Column, upper: bool) -> Column:
    """64 parities: bit b counts (mod 2) the words that hash to it; ``upper``: those
    with the highest bit of their hash alone."""
    one, low = F.lit(1).cast("long"), F.lit(63).cast("long")
    return F.aggregate(words_, F.lit(0).cast("long"), lambda a, w: a.bitwiseXOR(
        F.call_function("shiftleft", F.shiftrightunsigned(w, 63) if upper else one, w.bitwiseAND(low).cast("int"))))


def least_overlap(percent: int) -> Column:
    """Common words that sets of ``a_n`` and ``b_n`` words need."""
    return F.ceil((F.col("a_n") + F.col("b_n")) * percent / (100 + percent))


def may_be_similar(percent: int) -> Column:
    """Length and bitmap filters for columns of two classes (``a_``, ``b_``)."""
    na, nb = F.col("a_n"), F.col("b_n")
    upper = F.col("a_p1").bitwiseXOR(F.col("b_p1"))
    distance = F.bit_count(upper) + F.bit_count(F.col("a_p").bitwiseXOR(F.col("b_p")).bitwiseXOR(upper))
    return (na * 100 >= nb * percent) & (nb * 100 >= na * percent) & (distance <= na + nb - 2 * least_overlap(percent))


def group_keys(words_: Column) -> Column:
    """``GROUPS`` keys, each of the least and the greatest of the words' hashes."""
    keys = [F.xxhash64(words_[0], F.element_at(words_, -1))]
    for i in range(1, GROUPS):
        again = F.transform(words_, lambda w, i=i: F.xxhash64(w, F.lit(i)))
        keys.append(F.xxhash64(F.array_min(again), F.array_max(again)))
    return F.array(*keys)


def verified(pairs: DataFrame, firsts: DataFrame, docs: DataFrame, percent: int) -> DataFrame:
    """(c1, c2), written, of the later class of every pair (a_c1, b_c1) whose whole sets
    reach the similarity.  At most SLOTS numbers pick the documents, and then the
    first lines, of the classes before any word is hashed, so little of the text is
    taken up again and little moves to the exact join."""
    wanted = pairs.select(F.col("a_c1").alias("c1")).unionByName(pairs.select(F.col("b_c1").alias("c1"))).distinct()
    wanted = cut_lineage(firsts.select("c1", "c2", F.col("first").alias("place"), F.xxhash64("first").alias("at")).join(
        wanted, "c1", "left_semi"))
    document = lambda number, key: slot(F.xxhash64(number, key))
    held = F.broadcast(wanted.select(document(F.col("place.number"), F.col("place.text_key")).alias("held")).distinct())
    some = F.broadcast(wanted.select(slot(F.col("at")).alias("some")).distinct())
    holding = docs.select("doc_id", text_or_empty().alias("text")).join(
        held, document(doc_number(), F.xxhash64("text")) == F.col("held"), "left_semi")
    found = places(holding).select(F.xxhash64(place()).alias("at"), "line").join(
        some, slot(F.col("at")) == F.col("some"), "left_semi").join(wanted, "at")
    # places meet by their hash: only the line with the digest asked for speaks
    # for its class
    fetched = found.select(F.col("c1").alias("is1"), F.col("c2").alias("is2"), "place", words(F.col("line")).alias("words"))
    sets = with_class(fetched).where("c1 = is1 AND c2 = is2")
    sets = cut_lineage(sets.groupBy("c1", "c2").agg(F.first("place").alias("place"), F.first("words").alias("words")))
    of = lambda s: sets.select(*[F.col(x).alias(f"{s}_{x}") for x in sets.columns])
    both = pairs.join(of("a"), "a_c1").join(of("b"), "b_c1")
    shared = F.size(F.array_intersect("a_words", "b_words"))
    links = both.where(shared * 100 >= (F.size("a_words") + F.size("b_words") - shared) * percent)
    later = F.when(F.col("a_place") > F.col("b_place"), F.struct(F.col("a_c1").alias("c1"), F.col("a_c2").alias("c2"))).otherwise(
        F.struct(F.col("b_c1").alias("c1"), F.col("b_c2").alias("c2")))
    out = cut_lineage(links.select(later.alias("c")).select("c.*").distinct())
    release(wanted, sets)
    return out


def described(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """(doc_id, text_key, line_no, c1, c2, n, p, p1, groups, prefix), written, of every
    line with words: its class and what the joins need of its set."""
    levels = word_levels(docs)
    size = F.size("words")
    length = (size - F.ceil(size * percent / 100) + 1).cast("int")
    # 31 bits of a word's number are its key in the join
    prefix = F.transform(F.slice("ranked", F.lit(1), length), lambda w: w.bitwiseAND(F.lit(2**31 - 1).cast("long")).cast("int"))
    # the optimizer moves the subquery into the expression below (it may not be
    # written there); no row carries the levels
    every = with_class(lines(docs)).withColumn("levels", levels)
    return cut_lineage(every.withColumn("ranked", by_rarity(F.col("words"), F.col("levels"))).select(
        "doc_id", "text_key", "line_no", "c1", "c2", size.alias("n"), parity(F.col("words"), False).alias("p"),
        parity(F.col("words"), True).alias("p1"), group_keys(F.col("words")).alias("groups"), prefix.alias("prefix")))


def similar_classes(docs: DataFrame, found: DataFrame, percent: int = PERCENT) -> DataFrame:
    """(c1, c2, first, lines, similar), written, of every class of ``found``
    (``described``): the place of its first line, its number of lines, and whether
    that line is similar to an earlier class's (true or null)."""
    spark = docs.sparkSession
    firsts = cut_lineage(found.withColumn("place", place()).groupBy("c1", "c2").agg(
        F.min("place").alias("first"), F.count("*").alias("lines"), *[F.first(x).alias(x) for x in ("n", "p", "p1", "groups", "prefix")]))
    collect_garbage(spark)
    # each class against the earliest of its groups
    grouped = firsts.select("c1", "first", "n", "p", "p1", F.explode("groups").alias("key"))
    heads = grouped.groupBy("key").agg(
        F.min(F.struct("first", "c1", "n", "p", "p1")).alias("head"), F.count("*").alias("members")).where("members > 1")
    heads = heads.select("key", *[F.col(f"head.{x}").alias(f"a_{x}") for x in ("c1", "n", "p", "p1")])
    stars = heads.join(grouped.select("key", *[F.col(x).alias(f"b_{x}") for x in ("c1", "n", "p", "p1")]), "key").where(
        (F.col("a_c1") != F.col("b_c1")) & may_be_similar(percent)).select("a_c1", "b_c1").distinct()
    stars = cut_lineage(stars)
    decided = verified(stars, firsts, docs, percent)
    release(stars)
    # the prefix join, for an earlier partner of the undecided
    marked = firsts.join(decided.withColumn("decided", F.lit(True)), ["c1", "c2"], "left").withColumn(
        "open", F.col("decided").isNull().cast("int"))
    # of the place, the number alone goes with every word: classes whose first
    # lines tie in it meet once, and the verification tells which is the later
    posts = marked.select("c1", "first.number", "n", "p", "p1", "open", F.posexplode("prefix").alias("at", "key"))
    a, b = (posts.select("key", *[F.col(x).alias(f"{side}_{x}") for x in posts.columns if x != "key"]) for side in "ab")
    na, nb = F.col("a_n"), F.col("b_n")
    room = F.least(na - F.col("a_at"), nb - F.col("b_at"))
    # both sides hold the same columns and share one shuffle
    earlier = (F.col("a_number") < F.col("b_number")) & (F.col("b_open") == 1)
    tied = (F.col("a_number") == F.col("b_number")) & (F.col("a_c1") < F.col("b_c1")) & (F.col("a_open") + F.col("b_open") > 0)
    near = a.join(b, (a["key"] == b["key"]) & (earlier | tied) & (room >= least_overlap(percent)) & may_be_similar(percent))
    pairs = cut_lineage(near.select("a_c1", "b_c1").distinct())
    collect_garbage(spark)
    more = verified(pairs, firsts, docs, percent)
    later = decided.unionByName(more).distinct().withColumn("similar", F.lit(True))
    out = cut_lineage(firsts.select("c1", "c2", "first", "lines").join(later, ["c1", "c2"], "left"))
    # what is not read any more goes at once
    release(firsts, decided, pairs, more)
    return out


def removed_lines(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """(doc_id, text_key, removed), written: the numbers of the lines that go, of
    every document that has one."""
    found = described(docs, percent)
    classes = similar_classes(docs, found, percent)
    # nothing goes of a class that has one line and no earlier partner
    hit = classes.where("similar IS NOT NULL OR lines > 1")
    # at most COMMON classes hold more than that share of all lines: those are sent
    # to every task, so a line that stands in a third of the documents is no hot key
    common = F.col("lines") * COMMON > found.count()
    known = ["c1", "c2", "first", "similar"]
    own = found.select("doc_id", "text_key", "line_no", "c1", "c2")
    often = F.broadcast(hit.where(common).select(*known))
    rest = own.join(often, ["c1", "c2"], "left_anti").join(hit.where(~common).select(*known), ["c1", "c2"])
    gone = own.join(often, ["c1", "c2"]).unionByName(rest).where(F.col("similar").isNotNull() | (place() > F.col("first")))
    out = cut_lineage(gone.groupBy("doc_id", "text_key").agg(F.collect_set("line_no").alias("removed")))
    release(classes, found)
    return out


def _shortened(docs: DataFrame, percent: int) -> DataFrame:
    """(row, text, n_lines, n_removed) of every row of ``docs``."""
    removed = removed_lines(docs, percent).select(
        F.col("doc_id").alias("__id"), F.col("text_key").alias("__key"), "removed")
    collect_garbage(docs.sparkSession)
    rows = docs.select(F.struct("*").alias("row"), text_or_empty().alias("text"), "doc_id")
    joined = rows.join(removed, rows["doc_id"].eqNullSafe(F.col("__id")) & (F.xxhash64("text") == F.col("__key")), "left")
    all_lines = F.split("text", "\n")
    kept = F.array_except(F.sequence(F.lit(0), F.size(all_lines) - 1), F.coalesce("removed", F.array().cast("array<int>")))
    shorter = F.concat_ws("\n", F.transform(kept, lambda i: F.get(all_lines, i)))
    n_removed = F.when(F.col("removed").isNull(), 0).otherwise(F.size("removed"))
    n_lines = F.size(F.filter(all_lines, lambda x: x.rlike(WORD)))
    text = F.when(n_removed > 0, shorter).otherwise(F.col("row.text"))
    return joined.select("row", text.alias("text"), n_lines.cast("long").alias("n_lines"),
                         n_removed.cast("long").alias("n_removed"))


def shorten(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """The rows of ``docs``, all columns in place, with their text shortened."""
    columns = [F.col("text") if c == "text" else F.col(f"row.`{c}`") for c in docs.columns]
    return _shortened(docs, percent).select(*columns)


def dedup_lines(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """The rows of ``docs`` with their text shortened, and the columns ``n_lines``
    and ``n_removed`` (columns of these names are replaced)."""
    others = [F.col(f"row.`{c}`") for c in docs.columns if c not in ("text", "n_lines", "n_removed")]
    return _shortened(docs, percent).select(*others, "text", "n_lines", "n_removed")
