"""Benchmark decontamination by spaced-seed hashing, in DataFrame functions alone.

Texts become arrays of 64-bit hashes of lower-cased words of letters and digits; in scripts that are written without spaces
(UNSPACED) each letter is a word. A mask of SPAN places cares for some of them and ignores the others; every window of a text
has a hash of the cared-for words for each mask. Hashes of test items are joined with those of training windows; a hit names
an item and a diagonal (where in the document the item would begin). Each hit is verified word by word along its
diagonal: some VERIFY consecutive places (all, in shorter items) must agree in at least ``agree`` of them. The masks hit
within every run of places that this accepts, for items of any length (an enumeration in the tests proves it), so the
seeds decide nothing. Substituted words are so tolerated, insertions split a passage into two diagonals. Items of fewer
than SPAN words have no mask: their seed is the hash of all their words, which must stand in the document one after
another.

Texts are cut into stretches of STRETCH windows before windows are made, and a hit carries the few words around it alone, so
that what a task buffers doesn't grow with a text's hits times its length. Items of equal words are looked for once, and
their ids are joined to what was found in the end. Items longer than PIECE words are cut into pieces that share VERIFY - 1
words, so no item makes a broadcast large. Pieces are dealt to blocks of about BLOCK seeds, as many blocks as the counted
seeds need. A block's seeds and words are broadcast, and windows are generated, joined and verified within one stage: no
shuffle carries the corpus, however many items there are; more items of other words mean more scans, one after another, so
that one block's broadcasts are needed at a time. Only verified diagonals are grouped.

Defined cases: a null text has no words, and a text or an item without words matches nothing; ``leaks`` reports items of
any length from one word, ``decontaminate`` removes documents for items of at least LEAST words, as shorter ones stand in
clean documents by chance; items with a null item_id are found and reported under null, items of equal id each by its own
text; repeated rows and items give one row for each (doc_id, item_id); null doc_ids are reported together under null; an
empty table on either side gives an empty result; other columns are not looked at.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import packed, small_side, unpacked, written

#: Places that count (1) and places that are ignored (0).
MASKS = ("111010011", "110100111", "101101101")
SPAN = len(MASKS[0])
#: With these, every placing of substitutions that VERIFY and AGREE accept leaves some mask a window whose places that count agree.
ALL_MASKS = (*MASKS, "110011101", "111110001", "010111110", "001110111", "101111100")
VERIFY, AGREE = 16, 0.8
#: Seeds of a block on average; words of a piece; windows of a stretch.
BLOCK, PIECE, STRETCH = 2_000_000, 4096, 1024
#: Words that an item must have for documents to be removed for it.
LEAST = 4
#: Scripts that are written without spaces between words.
UNSPACED = ("Han", "Hiragana", "Katakana", "Thai", "Lao", "Khmer", "Myanmar")


def word_hashes(text: Column) -> Column:
    letters = "".join(rf"\p{{Is{x}}}" for x in UNSPACED)
    late = r"[\x{E00}-\x{10FFFF}]"  # all of these scripts; told before the scripts, which are slow to look up
    apart = F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), f"([{late}&&[{letters}]])", " $1 ")
    words = F.filter(F.split(apart, r"[^\p{L}\p{N}]+"), lambda w: w != "")
    return F.transform(words, lambda w: F.xxhash64(w))


def _stretches(docs: DataFrame, keep: list[str], least: int, before: int, after: int, stretch: int) -> DataFrame:
    """keep columns, base, first, last, h: a row for each ``stretch`` windows of a text, of ``least`` words at least.

    h holds the words of the text from base on, up to ``before`` ahead of the stretch and ``after`` of its last window; the
    stretch's windows begin at places first to last of h.
    """
    words = docs.select(*keep, word_hashes(F.col("text")).alias("_words"))
    n = F.size("_words")
    starts = F.when(n >= least, F.sequence(F.lit(0), n - least, F.lit(stretch))).otherwise(F.array().cast("array<int>"))

    def cut(start: Column) -> Column:
        base = F.greatest(start - before, F.lit(0))
        last = F.least(start + (stretch - 1), n - least)
        return F.struct(base.alias("base"), (start - base).alias("first"), (last - base).alias("last"), F.slice("_words", base + 1, last - base + after).alias("h"))

    # no filter on _words: it would be moved below, and texts cut into words twice
    return words.select(*keep, F.inline(F.transform(starts, cut)))


def _seeds(words: DataFrame, keep: list[str], masks: tuple[str, ...], short: list[int], guarded: bool) -> DataFrame:
    """keep columns, the array ``h``, place, seed: for each window of h that begins at places first to last, and each mask; and
    for windows of the short lengths.

    guarded: seeds are null where h ends before the window does. Without that, such a window is hashed without the words it
    lacks, and what it hits isn't verified; all masks then share their reading of the array. All of it is compiled code (no
    filter of arrays), so that rows with h are never buffered.
    """
    placed = words.select(*keep, "h", F.explode(F.sequence("first", "last")).alias("place"))
    word = lambda i: F.get("h", F.col("place") + i)
    within = lambda n, seed: F.when(F.col("place") + n <= F.size("h"), seed) if guarded else seed
    seeds = [within(len(m), F.xxhash64(F.lit(k), *(word(i) for i, c in enumerate(m) if c == "1"))) for k, m in enumerate(masks)]
    seeds += [within(n, F.xxhash64(F.lit(-n), *(word(i) for i in range(n)))) for n in short]
    return placed.select(*keep, "h", "place", F.explode(F.array(*seeds)).alias("seed"))


def _worded(items: DataFrame, least: int) -> DataFrame:
    """item_id, words (two hashes of them all, alike for items of equal words), h, of items of ``least`` words or more."""
    whole = items.select("item_id", word_hashes(F.col("text")).alias("h")).where(F.size("h") >= max(least, 1)).distinct()
    words = F.struct(F.xxhash64("h").alias("x"), F.xxhash64(F.lit(1), "h").alias("y"))
    return written(whole.select("item_id", words.alias("words"), "h"), "decontaminate-items")


def _pieces(whole: DataFrame, verify: int, piece: int) -> DataFrame:
    """words, size (of the item), at (where the piece begins), h (the piece's words), key (which piece it is)."""
    size = F.size("h")
    starts = F.sequence(F.lit(0), F.greatest(size - verify, F.lit(0)), F.lit(piece - verify + 1))
    cut = whole.dropDuplicates(["words"]).select("words", "h", size.alias("size"), F.explode(starts).alias("at"))
    return cut.select("words", "size", "at", F.slice("h", F.col("at") + 1, F.lit(piece)).alias("h"), F.struct("words.x", "words.y", "at").alias("key"))


def leaks(docs: DataFrame, items: DataFrame, keep: tuple[str, ...] = ("doc_id",), least: int = 1, **how) -> DataFrame:
    """keep columns, item_id, agreeing (most agreeing places of a window), doc_place (where the item would begin), of items of
    ``least`` words or more."""
    whole = _worded(items, least)
    found = _found(docs, whole, keep, **how).join(small_side(whole.select("item_id", "words")), "words")
    found = found.groupBy(*keep, "item_id").agg(F.max("b").alias("b"))  # an id may stand for several texts
    return found.select(*keep, "item_id", F.col("b.agreeing").alias("agreeing"), (-F.col("b.d")).alias("doc_place"))


def _found(docs: DataFrame, whole: DataFrame, keep: tuple[str, ...], masks: tuple[str, ...] = ALL_MASKS, verify: int = VERIFY, agree: float = AGREE, block: int = BLOCK, piece: int = PIECE, stretch: int = STRETCH) -> DataFrame:
    """keep columns, words, b (agreeing and the least place, negative, of the best diagonal)."""
    span = len(masks[0])
    test = written(_pieces(whole, verify, piece), "decontaminate-pieces")
    seeds, short = test.agg(F.coalesce(F.sum(F.size("h")), F.lit(0)), F.collect_set(F.when(F.col("size") < span, F.col("size")))).first()
    blocks = max(1, -(-seeds * len(masks) // block))
    part = lambda i: test if blocks == 1 else test.where(F.pmod(F.xxhash64("key"), F.lit(blocks)) == i)
    train = _stretches(docs, [*keep], min([span, *short]), verify - span, verify, stretch)
    best = F.max(F.struct("agreeing", (-F.col("diagonal")).alias("d"))).alias("b")
    found = (_verified(train, part(i), keep, masks, sorted(short), verify, agree).groupBy(*keep, "words").agg(best) for i in range(blocks))
    if blocks == 1:
        return next(found)
    found = reduce(DataFrame.union, (written(x, "decontaminate-block") for x in found))  # one block after another
    return found.groupBy(*keep, "words").agg(F.max("b").alias("b"))


def _hits(train: DataFrame, seeds: DataFrame, keep: tuple[str, ...], masks: tuple[str, ...], short: list[int], verify: int) -> DataFrame:
    """keep columns, key, item_place, place (in the text), lead (words of ``near`` ahead of place), near: the words around each
    hit that its verification looks at.

    What one stretch hits is buffered, so near is cut out in the same compiled code and h goes no further.
    """
    hits = _seeds(train, [*keep, "base"], masks, short, False).join(F.broadcast(seeds), "seed")  # a block's seeds
    lead = F.least("place", "item_place", F.lit(verify - len(masks[0])))
    near = F.slice("h", F.col("place") - lead + 1, lead + verify)
    return hits.select(*keep, "key", "item_place", (F.col("base") + F.col("place")).alias("place"), lead.alias("lead"), near.alias("near"))


def _verified(train: DataFrame, test: DataFrame, keep: tuple[str, ...], masks: tuple[str, ...], short: list[int], verify: int, agree: float) -> DataFrame:
    """keep columns, words, diagonal, agreeing of each accepted hit, for a block of pieces.

    An accepted run of places has a hit inside, so it is enough to look at the runs around each hit: the work for a hit
    doesn't grow with the text or the item.
    """
    span = len(masks[0])
    least = min([span, *short])
    placed = test.where(F.size("h") >= least).select("key", "size", "h", F.lit(0).alias("first"), (F.size("h") - least).alias("last"))
    seeds = _seeds(placed, ["key", "size"], masks, short, True).where(F.col("seed").isNotNull() & ((F.col("size") >= span) | (F.col("place") == 0)))
    seeds = seeds.select("seed", "key", F.col("place").alias("item_place")).distinct()
    items = test.select("key", "words", "size", "at", F.col("h").alias("item"))
    hits = _hits(train, seeds, keep, masks, short, verify).join(F.broadcast(items), "key")  # a block's words
    most = F.least(F.size("near"), F.col("lead") + F.least(F.lit(verify), F.size("item") - F.col("item_place")))
    same = F.zip_with(F.slice("near", F.lit(1), most), F.slice("item", F.col("item_place") - F.col("lead") + 1, most), lambda a, b: (a == b).cast("int"))
    found = hits.select(*keep, "words", (F.col("place") - F.col("item_place") - F.col("at")).alias("diagonal"), F.least(F.lit(verify), "size").alias("wide"), same.alias("same"))
    at = F.when(F.size("same") >= F.col("wide"), F.sequence(F.lit(1), F.size("same") - F.col("wide") + 1)).otherwise(F.array().cast("array<int>"))
    sums = F.transform(at, lambda p: F.aggregate(F.slice("same", p, F.col("wide")), F.lit(0), lambda s, x: s + x))
    needed = F.when(F.col("wide") < span, F.col("wide")).otherwise(F.ceil(F.col("wide") * agree))
    found = found.withColumn("agreeing", F.array_max(sums)).where(F.col("agreeing") >= needed)
    return found.select(*keep, "words", "diagonal", "agreeing")


def decontaminate(docs: DataFrame, items: DataFrame, least: int = LEAST, **how) -> DataFrame:
    """docs without the rows whose text shares a passage with an item of LEAST words or more.

    Rows are told apart by the text's hash and length, for equal texts leak alike.
    """
    keyed = packed(docs, text=F.col("text"), _h=F.xxhash64("text"), _n=F.coalesce(F.length("text"), F.lit(-1)))
    found = written(_found(keyed, _worded(items, least), ("_h", "_n"), **how).select("_h", "_n").distinct(), "leaks")
    return unpacked(keyed.join(small_side(found), ["_h", "_n"], "left_anti"), docs.columns)
