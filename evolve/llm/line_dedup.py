"""Near-duplicate lines by a segment-partition edit join, in DataFrame operations only.

Lines within edit distance t of each other, cut into t + 1 segments, must have a segment
of one in the other, at a place that differs by no more than the edits can shift it. So
every distinct line is put into an index by its segments and its length, and probes the
index with the substrings that could be a segment of a line of its own length or up to t
shorter; only the places that the number of edits left and right of a segment allows are
probed. Candidates are verified by the edit distance with that bound.

Equal lines are one class and are joined once. Classes within the distance, and those
linked through others, are one group, of which the first line (by document id, then by
place) stays; all others are dropped. Lines are compared without the white space at
their ends. Lines shorter than ``SHORTEST`` characters have no near ones: with ``exact``
they are dropped where they equal an earlier line, else never; blank ones always stay.

Groups without all pairs. First every line is compared with one line of each of its
buckets, the centre, which makes a family of lines one group. Then, in buckets of up to
``SMALL`` indexed lines, pairs of different groups are compared whose marks allow it: of
lines that merely share a segment, nearly none are. Marks are 64 parities of the counts of
a line's pairs of neighbouring characters; an edit changes four at most, so lines within
the distance never differ in more than four for each edit. In larger buckets that still hold several groups, a line looks for lines of other groups in blocks of about ``BLOCK``
and keeps at most one link, until no line finds one. A line that finds none has none,
since groups only grow, so only those that found one look again. Buckets of more than
``HOT`` lines are narrowed before that: what is left of the lines without the shared
segment is within the same distance, so it is cut into segments in its turn. Links grow
with the lines, not with their pairs, and what the largest step makes is (line, block).

Defined results: a null text has no lines and stays null; an empty text has one empty
line; a document without id keeps all its lines; repeated rows of one document share its
decisions; a text of which all lines go becomes empty; further columns stay as they are;
an empty table gives an empty one.
"""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from evolve.llm.components import components
from evolve.storage import stored

EDITS = 2
SHORTEST = 24
# Shorter lines are dropped where they equal an earlier one, from this many characters on.
EXACT = 1
BREAK = "\n"
# Places in a document that a number for document and place has room for.
PLACES = 1 << 31
# White space that may stand in a line.
BLANKS = " \t\r\x0b\x0c\x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
WORD = r"[0-9A-Za-z]|[^\x00-\x7F]"
# Ids are sent to every task up to a counted number, 8 MB; beyond it they are shuffled.
SENT_ROWS = 1_000_000
# Indexed lines up to which a bucket is compared by pairs, lines of a block, lines that look through one copy of it,
# and lines above which a bucket is narrowed.
SMALL = 32
BLOCK = 256
LOOKING = 4096
HOT = 256


def _trimmed(raw: str) -> Column:
    """Without white space at the ends; most lines have none, and a look at the ends costs less than a walk through the line."""
    ends = reduce(or_, [F.startswith(F.col(raw), F.lit(b)) | F.endswith(F.col(raw), F.lit(b)) for b in BLANKS])
    return F.when(ends, F.btrim(raw, F.lit(BLANKS))).otherwise(F.col(raw))


def lines(docs: DataFrame, text: str, key: str, shortest: int, exact: int | None = None) -> DataFrame:
    """doc, pos, line (without white space at its ends) of the lines that can be dropped."""
    least = shortest if exact is None else max(1, min(exact, shortest))
    return (
        docs.where(F.col(key).isNotNull() & F.col(text).isNotNull())
        .select(F.col(key).cast("long").alias("doc"), F.posexplode(F.split(text, BREAK, -1)).alias("pos", "raw"))
        .select("doc", "pos", _trimmed("raw").alias("line")).where(F.length("line") >= least)
    )


def _places(edits: int, own: bool) -> Column:
    """Structs of d, i, s: segment i of a line that is d shorter, s to the right of its place there.

    A shift of s needs |s| edits to the left of the segment and |s - d| to its right. With at most i errors
    left of the first segment that agrees, and edits - i right of it, only |s| <= i and |s - d| <= edits - i
    need a look. ``own``: the line's own segments (d and s are 0), else all the others.
    """
    found = [(d, i, s) for d in range(edits + 1) for i in range(edits + 1) for s in range(-i, i + 1) if abs(s - d) <= edits - i]
    return F.array(*[F.struct(F.lit(d).alias("d"), F.lit(i).alias("i"), F.lit(s).alias("s")) for d, i, s in found if (d == s == 0) == own])


def buckets(rows: DataFrame, edits: int, own: bool, rest: bool = False) -> DataFrame:
    """id and bucket: what a line is indexed under (``own``), or where else it finds lines up to ``edits`` shorter.

    ``rows``: id, line, n (its characters) and, for lines that are compared within one, parent. A bucket is a
    64-bit hash of the parent, the indexed line's length, the segment's number and its characters; collisions are
    left to the verification. The last segments are longer by the rest of the division. The places are exploded
    first, so that one short expression serves them all. Where every character is one byte, segments are cut by
    bytes, which have the same hash and need no walk along the line. ``rest``: also the line without the segment, and its length.
    """
    k = edits + 1
    parent = [F.col("parent")] if "parent" in rows.columns else []
    plain = F.when(F.octet_length("line") == F.col("n"), F.col("line").cast("binary")).alias("plain")
    placed = rows.select("id", "line", plain, "n", *parent, F.explode(_places(edits, own)).alias("p"))
    m = F.expr("n - p.d")
    size, long_ones = F.expr(f"(n - p.d) div {k}").cast("int"), F.expr(f"(n - p.d) % {k}")
    first_long = F.lit(k) - long_ones
    start = size * F.col("p.i") + F.greatest(F.col("p.i") - first_long, F.lit(0)) + F.col("p.s")
    length = size + F.when(F.col("p.i") >= first_long, 1).otherwise(0)
    by_plain, by_line = (F.xxhash64(*parent, m, F.col("p.i"), F.col(c).substr(start + 1, length)) for c in ("plain", "line"))
    bucket = F.when(F.col("plain").isNotNull(), by_plain).otherwise(by_line).alias("bucket")
    inside = placed.where((m > 0) & (start >= 0) & (start + length <= F.col("n")))
    if not rest:
        return inside.select("id", bucket)
    left = F.concat(F.col("line").substr(F.lit(1), start), F.col("line").substr(start + length + 1, F.col("n")))
    return inside.select("id", bucket, left.alias("line"), (F.col("n") - length).alias("n"))


def _place(doc: str, pos: str) -> Column:
    """Document and place in one number that sorts as the two do, as an aggregate by hash can hold it."""
    return F.col(doc).cast("decimal(20,0)") * F.lit(PLACES).cast("decimal(10,0)") + F.col(pos).cast("decimal(10,0)")


def _doc_pos(place: str) -> Column:
    """The document and place of such a number."""
    pos = F.expr(f"pmod({place}, cast({PLACES} as decimal(10,0)))")
    return F.struct(F.expr(f"({place} - pmod({place}, cast({PLACES} as decimal(10,0)))) div cast({PLACES} as decimal(10,0))").alias("doc"), pos.cast("int").alias("pos"))


def classes_of(found: DataFrame) -> DataFrame:
    """Distinct lines: id, h1, h2 (hashes), line, n (characters), first (the number of the first place), many."""
    one = found.groupBy("line").agg(F.min(_place("doc", "pos")).alias("first"), F.count("*").alias("many"))
    return stored(one.select(F.monotonically_increasing_id().alias("id"), *_names("line"), "first", "many", F.length("line").alias("n"), "line"))


def _names(line: str) -> list[Column]:
    return [F.xxhash64(line).alias("h1"), F.hash(F.lit(7), F.col(line)).alias("h2")]


def marks(line: str) -> Column:
    """64 bits, each whether an odd number of the line's pairs of neighbouring characters fall to it: an edit flips four of them at most."""
    bit = lambda *pair: F.call_function("shiftleft", F.lit(1).cast("long"), F.pmod(F.hash(*pair), F.lit(64)))
    start = F.struct(F.lit(0).cast("long").alias("held"), F.lit("").alias("last"))
    step = lambda x, c: F.struct(x["held"].bitwiseXOR(bit(x["last"], c)).alias("held"), c.alias("last"))
    return F.aggregate(F.split(line, ""), start, step, lambda x: x["held"])


def _alike(a: Column, b: Column, edits: int) -> Column:
    """Whether two lines with these marks can be within the distance."""
    return F.bit_count(a.bitwiseXOR(b)) <= 4 * edits


def _few(df: DataFrame) -> DataFrame:
    """Stored in a few files per core, where a shuffle has many more partitions than that: what is left is small."""
    return stored(df.coalesce(_files(df)))


def _files(df: DataFrame) -> int:
    return 3 * df.sparkSession.sparkContext.defaultParallelism


def _sized(df: DataFrame) -> DataFrame:
    """Ids, sent to every task if they are counted to be few, else left to a shuffle."""
    return F.broadcast(df) if df.count() <= SENT_ROWS else df


def _shared(index: DataFrame, probes: DataFrame) -> DataFrame:
    """bucket, id, own (indexed there), centre (the first indexed line), n (indexed lines): of lines that share a bucket."""
    heads = stored(index.groupBy("bucket").agg(F.min("id").alias("centre"), F.count("*").alias("n")))
    several = _sized(heads.where("n > 1"))
    # One row a bucket, so a partition's heads can be held, and the many probes need no sorting.
    probing = probes.join(heads.hint("shuffle_hash"), "bucket").where("n > 1 or id <> centre").withColumn("own", F.lit(False))
    indexed = index.join(several, "bucket").withColumn("own", F.lit(True))
    # Dealt anew rather than put together, so that each partition is joined in a task of its own.
    return stored(probing.unionByName(indexed).repartition(_files(index)))


def _verified(pairs: DataFrame, line: DataFrame, edits: int) -> DataFrame:
    """Those of the pairs (a, b) that are within the distance."""
    both = pairs.distinct().join(line.toDF("a", "la"), "a").join(line.toDF("b", "lb"), "b")
    return _few(both.where(F.levenshtein("la", "lb", edits) >= 0).select("a", "b"))


def _across(now: DataFrame, line: DataFrame, edits: int) -> DataFrame:
    """Links (a, b) from lines that look to a line of another group in one of their buckets, at most one for each.

    ``now``: bucket, id, own, looks, component; ``line``: id, line, marks. Indexed lines are put together in blocks; those that look go to
    every block of their bucket, dealt to as many copies of it as their number needs.
    """
    sizes = now.groupBy("bucket").agg(
        F.min("component").alias("low"), F.max("component").alias("high"), F.ceil(F.count_if("own") / BLOCK).cast("int").alias("blocks"),
        F.ceil(F.count_if("looks") / LOOKING).cast("int").alias("parts"))
    work = now.join(sizes.where("low <> high and blocks > 0 and parts > 0").drop("low", "high"), "bucket").join(line, "id")
    # The least of the block's own groups tells at once that there is no other.
    blocks = work.where("own").groupBy("bucket", F.pmod(F.xxhash64("id", F.lit(17)), F.col("blocks")).cast("int").alias("block")).agg(
        F.collect_list(F.struct("id", "component", "marks", "line")).alias("there"), F.max("parts").alias("parts"))
    blocks = blocks.withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))).drop("parts")
    looking = work.where("looks").select(
        "bucket", F.col("id").alias("a"), "component", "marks", "line", F.pmod(F.xxhash64("id", F.lit(5)), F.col("parts")).cast("int").alias("part"),
        F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"))
    other = lambda x: (x["component"] != F.col("component")) & _alike(x["marks"], F.col("marks"), edits)
    near = F.filter("there", lambda x: other(x) & (F.levenshtein("line", x["line"], edits) >= 0))
    found = looking.join(blocks, ["bucket", "block", "part"]).select("a", F.array_min(F.transform(near, lambda x: x["id"])).alias("b"))
    return _few(found.where("b is not null").groupBy("a").agg(F.min("b").alias("b")))


def groups(classes: DataFrame, edits: int) -> DataFrame:
    """node, component: the smallest id that each class (id, line, n) reaches by steps within the edit distance, for those that have one."""
    shared = _shared(buckets(classes, edits, True), buckets(classes, edits, False))
    ids = _sized(_few(shared.select("id").union(shared.select("centre")).distinct()))
    line = _few(classes.select("id", "line").join(ids, "id", "leftsemi"))
    to_centre = lambda rows: rows.where("id <> centre").select(F.col("id").alias("a"), F.col("centre").alias("b"))
    links = _verified(to_centre(shared), line, edits)
    component = components(links)

    def grouped(rows: DataFrame) -> DataFrame:
        return rows.join(component.toDF("id", "component"), "id", "left").withColumn("component", F.coalesce("component", "id"))

    several = grouped(shared.where("n > 1").select("bucket", "id", "own", "n"))
    open_ = several.groupBy("bucket").agg(F.min("component").alias("low"), F.max("component").alias("high")).where("low <> high").select("bucket")
    held = _few(several.join(open_, "bucket"))
    marked = _few(line.join(held.select("id").distinct(), "id", "leftsemi").withColumn("marks", marks("line")))
    few = held.where(F.col("n") <= SMALL).join(marked.select("id", "marks"), "id")
    others = few.where("own").select("bucket", F.col("id").alias("b"), F.col("component").alias("other"), F.col("marks").alias("there"))
    pairs = few.select("bucket", F.col("id").alias("a"), "component", "marks").join(others, "bucket")
    pairs = pairs.where((F.col("component") != F.col("other")) & _alike(F.col("marks"), F.col("there"), edits)).select("a", "b")
    more = _verified(pairs, line, edits)
    if not more.isEmpty():
        links = links.union(more)
        component = components(links)
    held = held.where(F.col("n") > SMALL).select("bucket", "id", "own", "n")
    hot = held.where(F.col("n") > HOT).select("bucket").distinct()
    if held.isEmpty():
        return component
    if not hot.isEmpty():
        hot = stored(hot)
        some = stored(classes.select("id", "line", "n").join(held.join(hot, "bucket", "leftsemi").select("id").distinct(), "id", "leftsemi"))
        inner = lambda own: stored(buckets(some, edits, own, rest=True).join(hot, "bucket", "leftsemi").withColumnRenamed("bucket", "parent"))
        indexed, probing = inner(True), inner(False)
        narrow = _shared(buckets(indexed, edits, True), buckets(indexed, edits, False).union(buckets(probing, edits, True)).union(buckets(probing, edits, False)))
        links = links.union(_verified(to_centre(narrow), line, edits))
        component = components(links)
        held = held.join(hot, "bucket", "leftanti").unionByName(narrow.where("n > 1").select("bucket", "id", "own", "n"))
    looks = None
    while True:
        now = held.select("bucket", "id", "own")
        now = now.withColumn("looks", F.lit(True)) if looks is None else now.join(looks, "id", "left").withColumn("looks", F.col("looks").isNotNull())
        more = _across(grouped(now), marked, edits)
        if more.isEmpty():
            return component
        links = links.union(more)
        component = components(links)
        looks = more.select(F.col("a").alias("id"), F.lit(True).alias("looks"))


def decisions(docs: DataFrame, text: str = "text", key: str = "doc_id", edits: int = EDITS, shortest: int = SHORTEST, exact: int | None = None) -> DataFrame:
    """doc, dropped (places, ascending), stays (doc and pos of the line that stays for each): of every document that loses lines.

    ``exact``: also lines of that many characters and more, short of ``shortest``, that equal an earlier one.
    """
    found = lines(docs, text, key, shortest, exact)
    classes = classes_of(found)
    group = groups(classes.where(F.col("n") >= shortest).select("id", "line", "n"), edits)
    grouped = classes.select("id", "h1", "h2", "first", "many").join(group.withColumnRenamed("node", "id"), "id", "left")
    grouped = grouped.withColumn("component", F.coalesce("component", "id"))
    heads = grouped.where("many > 1 or component <> id").select("component").distinct()
    mine = grouped.join(heads, "component", "leftsemi")
    stays = mine.groupBy("component").agg(F.min("first").alias("stays")).withColumn("stays", _doc_pos("stays"))
    per_class = mine.join(stays, "component").select("h1", "h2", "stays")
    at = found.select("doc", "pos", *_names("line")).join(per_class.hint("shuffle_hash"), ["h1", "h2"])
    lost = at.where((F.col("doc") != F.col("stays.doc")) | (F.col("pos") != F.col("stays.pos")))
    per_doc = lost.groupBy("doc").agg(F.array_sort(F.collect_set(F.struct("pos", "stays"))).alias("at"))
    return per_doc.select("doc", F.col("at.pos").alias("dropped"), F.col("at.stays").alias("stays"))


def report(docs: DataFrame, dropped: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """One row per document: key, n_lines, n_dropped, dropped (their places, comma-joined), stays (document:place of the line kept for each)."""
    counted = docs.select(F.col(key), F.when(F.col(text).isNull(), 0).otherwise(F.size(F.split(text, BREAK, -1))).cast("long").alias("n_lines"))
    out = counted.join(dropped, F.col(key).cast("long") == F.col("doc"), "left")
    return out.select(
        key, "n_lines", F.coalesce(F.size("dropped"), F.lit(0)).cast("long").alias("n_dropped"), F.coalesce(F.array_join("dropped", ","), F.lit("")).alias("dropped"),
        F.coalesce(F.array_join(F.transform("stays", lambda x: F.concat_ws(":", x["doc"], x["pos"])), ","), F.lit("")).alias("stays"))


def apply(docs: DataFrame, dropped: DataFrame, text: str = "text", key: str = "doc_id", emptied: bool = True) -> DataFrame:
    """``docs`` without the dropped lines; all other columns as they were.

    Without ``emptied``, documents that lose all their words go: what they said stands in others.
    """
    mark = "__dropped"
    out = docs.join(dropped.select(F.col("doc").alias("__doc"), F.col("dropped").alias(mark)), F.col(key).cast("long") == F.col("__doc"), "left")
    kept = F.array_join(F.filter(F.split(text, BREAK, -1), lambda x, i: ~F.array_contains(mark, i)), BREAK)
    if not emptied:
        out = out.where(F.col(mark).isNull() | kept.rlike(WORD) | ~F.col(text).rlike(WORD))
    return out.withColumn(text, F.when(F.col(mark).isNull(), F.col(text)).otherwise(kept)).select(*docs.columns)
