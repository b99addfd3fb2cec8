"""Groups spelling variants: words one edit apart, found with a bit-sliced index of letters by position.

Per block of words there is one bitset for each (position, letter): the words that have this letter there. A word is
looked up by walking its letters: the set of words equal so far is narrowed by the bitset of the letter, and three sets
of words with one error so far (replaced, missing or additional letter) by the bitsets of the same, the next and the
previous position. All words of a block are advanced at once, 64 by each machine word.

Blocks are kept small without losing a pair. The shorter of two near words, of length l, has its first difference in one
half of its letters, so both agree on the other half: words meet by (l, half, letters of the other half). Where more than
LIMIT words agree, the half is split again, down to single letters; then no more words can agree than there are pairs of
letters. A pair counts only in the region that holds its first difference, hence once.

Null texts have no words; repeated rows count again; ties between forms go to the smallest word in code-point order; an
empty table gives an empty result; other columns of the input are ignored. Very long words are a block of their own.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradeloom.sources.shared import discard, stored

#: Words of one block; a group of more is split by further letters.
LIMIT = 1024
#: Letters of one block, padding included.
BLOCK_LETTERS = 1 << 20
#: Distinct words that a task counts before it passes them on.
COUNTED = 1 << 17

#: A form is this many times as frequent as its variant.
DOMINANCE = 10


def count_words(documents: DataFrame, least_letters: int = 7, least_count: int = 2, spoil: int = 31) -> DataFrame:
    """(word, n) of runs of Latin letters, A-Z lower-cased, from whole texts.

    A run loses one letter where ``spoil`` divides the crc32 of ``<doc_id>:<run>`` (the letter at crc32 % length), which
    plants known misspellings; 0 leaves all runs as they are. A null id is written as an empty one.
    """
    runs = re.compile(f"[a-zÀ-ÿ]{{{least_letters},}}").findall

    def rows(seen: Counter) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(seen.keys(), pa.string()), pa.array(seen.values(), pa.int64())], names=["word", "n"])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter[str] = Counter()
        for batch in batches:
            for doc_id, text in zip(batch.column(0), batch.column(1)):
                if not text.is_valid:
                    continue
                # Bytes are lower-cased in A-Z only.
                words = runs(text.as_buffer().to_pybytes().lower().decode())
                if spoil:
                    start = zlib.crc32(f"{doc_id.as_py() if doc_id.is_valid else ''}:".encode())
                    for k, word in enumerate(words):
                        h = zlib.crc32(word.encode(), start)
                        if h % spoil == 0:
                            at = h % len(word)
                            words[k] = word[:at] + word[at + 1 :]
                seen.update(words)
                if len(seen) > COUNTED:
                    yield rows(seen)
                    seen.clear()
        yield rows(seen)

    counted = documents.select("doc_id", F.col("text").cast("string")).mapInArrow(count, "word string, n long")
    total = counted.groupBy("word").agg(F.sum("n").alias("n"))
    return total.where((F.length("word") >= least_letters) & (F.col("n") >= least_count))


def _region(short: Column, first: Column, last: Column) -> Column:
    return F.struct(short.alias("short"), first.alias("first"), last.alias("last"))


def _regions(words: DataFrame) -> DataFrame:
    """(word, n, short, first, last): both halves, for the word as the shorter and as the longer of a pair."""
    length = F.length("word")
    zero = F.lit(0)

    def halves(short: Column) -> list[Column]:
        middle = F.floor(short / 2).cast("int")
        return [_region(short, zero, middle), _region(short, middle, short)]

    every = F.array(*halves(length), *halves(length - 1))
    return words.select("word", "n", F.inline(every)).where("first < last")


def _split(regions: DataFrame) -> DataFrame:
    middle = F.floor((F.col("first") + F.col("last")) / 2).cast("int")
    both = F.array(_region(F.col("short"), F.col("first"), middle), _region(F.col("short"), middle, F.col("last")))
    return regions.select("word", "n", F.inline(both))


def _keyed(regions: DataFrame) -> DataFrame:
    """Adds ``key``, a hash of the region and of the letters before and after it.

    Words that share a key by chance only meet in vain: what is near is decided on whole words.
    """
    word = F.col("word")
    before = F.substring(word, F.lit(1), F.col("first"))
    after = F.substring(word, F.length(word) - F.col("short") + F.col("last") + 1, F.length(word))
    return regions.withColumn("key", F.xxhash64("short", "first", "last", before, after))


def _bits(flags: np.ndarray) -> np.ndarray:
    """Rows of flags as rows of 64-bit words."""
    packed = np.packbits(flags, axis=-1)
    room = -packed.shape[-1] % 8
    if room:
        packed = np.concatenate([packed, np.zeros((*packed.shape[:-1], room), np.uint8)], axis=-1)
    return packed.view(np.uint64)


def _letters(words: list[str], lengths: np.ndarray, width: int) -> tuple[np.ndarray, int]:
    """A row of small letter numbers per word, 0 where it has ended, and how many numbers there are."""
    padded = "".join(word.ljust(width, "\0") for word in words)
    points = np.frombuffer(padded.encode("utf-32-le", "surrogatepass"), np.uint32).reshape(len(words), width)
    known, numbers = np.unique(points, return_inverse=True)
    numbers = numbers.reshape(points.shape) + 1
    numbers[np.arange(width) >= lengths[:, None]] = 0
    return numbers, len(known) + 1


def near_sets(words: list[str], group: np.ndarray, short: np.ndarray, first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """A bitset per word of the words of its group that are near to it with their first difference in its region."""
    lengths = np.array([len(word) for word in words], np.int64)
    longest = int(lengths.max(initial=0))
    letters, n_letters = _letters(words, lengths, longest + 1)
    numbers = np.arange(n_letters)[:, None]

    def index(position: int) -> np.ndarray:
        return _bits(letters[:, position] == numbers)

    equal = _bits(group[:, None] == group)
    replaced, missing, more = np.zeros_like(equal), np.zeros_like(equal), np.zeros_like(equal)
    upto_first, upto_last = np.zeros_like(equal), np.zeros_like(equal)
    previous, here = np.zeros((n_letters, equal.shape[1]), np.uint64), index(0)
    for position in range(longest):
        following = index(position + 1)
        letter = letters[:, position]
        at_first, at_last = first == position, (last == position) & (last < short)
        upto_first[at_first] = equal[at_first]
        upto_last[at_last] = equal[at_last]
        same = here[letter]
        # The found word has a letter more, so this letter is at its next position.
        more = (more | equal) & following[letter]
        # The found word lacks this letter, or an earlier one, so this letter is at its previous position.
        missing = (missing & previous[letter]) | equal
        replaced = (replaced & same) | (equal & ~same)
        equal &= same
        previous, here = here, following
    as_short, as_long = lengths == short, lengths == short + 1
    replaced &= _bits(as_short[:, None] & (lengths[:, None] == lengths))
    more &= _bits(as_short[:, None] & (lengths[:, None] + 1 == lengths))
    missing &= _bits(as_long[:, None] & (lengths[:, None] - 1 == lengths))
    return (replaced | more | missing) & upto_first & ~upto_last


def _near(rows: pa.Table) -> Iterator[pa.RecordBatch]:
    """Per word of a block with near words: how many, and the best one."""
    _, place, size = np.unique(rows["key"].to_numpy(), return_inverse=True, return_counts=True)
    rows = rows.filter(pa.array(size[place] > 1))
    if not len(rows):
        return
    words, n = rows["word"].to_pylist(), rows["n"].to_pylist()
    order = sorted(range(len(words)), key=lambda i: (-n[i], words[i]))
    words, n = [words[i] for i in order], [n[i] for i in order]
    _, group = np.unique(rows["key"].to_numpy()[order], return_inverse=True)
    found = near_sets(words, group, *(rows[c].to_numpy()[order] for c in ("short", "first", "last")))
    count = np.bitwise_count(found).sum(axis=1, dtype=np.int64)
    at = np.flatnonzero(count)
    if not len(at):
        return
    # Words stand in order of preference, so the best one is the first bit.
    best = np.unpackbits(found[at].view(np.uint8), axis=1).argmax(axis=1)
    yield pa.RecordBatch.from_arrays(
        [pa.array([words[i] for i in at], pa.string()), pa.array(count[at]), pa.array([n[i] for i in best], pa.int64()), pa.array([words[i] for i in best], pa.string())],
        names=["word", "n_near", "best_n", "best"],
    )


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Whole groups of two words or more, several in one block while they are small. Rows come sorted by key."""
    rest: pa.Table | None = None
    for batch in batches:
        table = pa.Table.from_batches([batch])
        table = pa.concat_tables([rest, table]) if rest is not None else table
        keys = table["key"].to_numpy()
        if not len(keys):
            continue
        # The last group may go on in the next batch.
        at = int(np.flatnonzero(keys == keys[-1])[0])
        rest = table.slice(at)
        yield from _cut(table.slice(0, at))
    if rest is not None:
        yield from _cut(rest)


def _cut(table: pa.Table) -> Iterator[pa.Table]:
    keys, widths = table["key"].to_numpy(), table["short"].to_numpy() + 2
    starts = np.flatnonzero(np.diff(keys, prepend=~keys[:1]))
    sizes = np.diff(starts, append=len(keys))
    begin, held, width = 0, 0, 0
    for start, size in zip(starts.tolist(), sizes.tolist()):
        wider = max(width, int(widths[start]))
        if held and (held + size > LIMIT or (held + size) * wider > BLOCK_LETTERS):
            yield table.slice(begin, start - begin)
            begin, held, wider = start, 0, int(widths[start])
        held, width = held + size, wider
    if held:
        yield table.slice(begin, held)


def _search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for block in _blocks(batches):
        yield from _near(block)


def near_words(words: DataFrame, limit: int = LIMIT) -> DataFrame:
    """(word, n_near, best_n, best) of the words of ``words`` (word, n; each word once) that have near words.

    Groups of more than ``limit`` words are split.
    """
    regions = _regions(words)
    found = None
    while True:
        keyed = _keyed(regions)
        # A region of one letter cannot be split, and bounds its group by the alphabet.
        counts = keyed.where("last - first > 1").groupBy("key").agg(F.count("*").alias("size"))
        large = stored(counts.where(F.col("size") > limit).select("key"), "large-groups")
        # Their size decides between a broadcast and a sort-merge join.
        small = keyed.join(large, "key", "left_anti").repartition("key").sortWithinPartitions("short", "key")
        part = small.mapInArrow(_search, "word string, n_near long, best_n long, best string")
        found = part if found is None else found.unionByName(part)
        if large.isEmpty():
            break
        regions = stored(_split(keyed.join(large, "key", "left_semi")), "split-regions")
    best = F.min(F.struct((-F.col("best_n")).alias("minus"), "best")).alias("first")
    return found.groupBy("word").agg(F.sum("n_near").alias("n_near"), best).select("word", "n_near", (-F.col("first.minus")).alias("best_n"), "first.best")


def _roots(links: DataFrame) -> DataFrame:
    """(word, root) of (word, form), where forms lead to no circle: each round doubles the steps taken."""
    steps = stored(links.select("word", F.col("form").alias("root")), "steps")
    while True:
        further = steps.select(F.col("word").alias("_at"), F.col("root").alias("_next"))
        joined = steps.join(further, steps["root"] == further["_at"], "left")
        after = stored(joined.select("word", F.coalesce("_next", "root").alias("root"), F.col("_next").isNotNull().alias("moved")), "steps")
        discard(steps)
        if after.where("moved").isEmpty():
            return after.select("word", "root")
        steps = stored(after.select("word", "root"), "steps")
        discard(after)


def variants(words: DataFrame, dominance: int = DOMINANCE, limit: int = LIMIT) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of ``words`` (word, n; each word once).

    ``form`` is the most frequent near word if it is ``dominance`` times as frequent, ``root`` the last form on the way.
    """
    words = stored(words.select("word", F.col("n").cast("long").alias("n")), "words")
    near = near_words(words, limit).withColumnsRenamed({"word": "_word"})
    joined = words.join(near, words["word"] == near["_word"], "left")
    ruled = F.col("best_n") >= dominance * F.col("n")
    formed = stored(
        joined.select(
            "word",
            F.when(ruled, F.col("best")).alias("form"),
            "n",
            F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
            F.when(ruled, F.col("best_n")).alias("form_n"),
        ),
        "forms",
    )
    roots = _roots(formed.where("form is not null")).withColumnsRenamed({"word": "_word"})
    return formed.join(roots, formed["word"] == roots["_word"], "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
