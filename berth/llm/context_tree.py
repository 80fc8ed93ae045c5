"""Texts scored by context-tree weighting over bytes.

A text is a sequence of tokens: its words (A-Z lower-cased), then one end. A word is its bytes and
a closing blank, the end is one line feed; each byte is eight binary decisions, taken along a tree
of 255 nodes. For every node there is a context tree: the context of a byte are the DEPTH bytes
before it in the text, across words; what lies before the text counts as blanks. A node's context
estimates its next decision as Krichevsky and Trofimov do, (ones + 1/2) / (all + 1). Each context
is weighed against the next longer ones: half its own block probability and half the product of
what its extensions weigh. This gives, from root to leaf, the share that each depth has in the
estimate, and the probability of a decision is the mix of the estimates of all depths. A decision
never seen behind a context is estimated there as behind the next shorter context (behind
none as 1/2), so that shares of depths without counts are not lost to chance. Each decision has
two outcomes, so all tokens together have probability 1, and so have all texts with their ends.

All of it is done on distinct things, far fewer than bytes: each shard of texts (``matrix``) counts
its different byte strings of DEPTH + 1 (grams), these lists are added up, and the probability of a
gram's last byte is computed once for the corpus. Grams are sorted so that the contexts below
one context of LATEST bytes stand together; such a subtree has at most 256 ** (DEPTH + 1 - LATEST)
grams, whatever the corpus, and is walked with numpy, while the contexts above are joined level by
level. The grams' code lengths come back to the shards whose lists have them, where each text adds
up those of its bytes. The model grows with the corpus, and nothing of it is held in one place.

With ``across`` false contexts end where the token begins: a model of distinct words, for which
``word_bits`` brings the code lengths to the words alone.

Defined results: a null text is empty (its end alone); a null doc_id is scored, is not held out
and teaches nothing, as its fold is not known; repeated rows teach as often as they stand there;
without training tokens the base score is that of V = N = 0 and every decision has probability
1/2; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from berth.llm import matrix
from berth.llm.common import fold, stored

FOLDS, HELD_OUT = 7, 2
DEPTH = 5
LATEST = 3
END = "\n"
#: Words whose grams are looked up together.
WORDS_AT_ONCE = 200_000
#: Rows of whole groups that a task works on at a time.
ROWS_AT_ONCE = 100_000
#: Shards to a range of grams: a range's lists have as many grams as the lists of so many shards.
SHARDS_A_RANGE = 4
#: Bytes of a shard's texts whose grams are made at a time.
BYTES_AT_ONCE = 1 << 20

SCORES = (
    "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, "
    "base_score double, score double, n_bytes long, bits_per_byte double"
)
_BLANK = 0x20
_CODEC = pa.Codec("zstd")
_SPREAD = 2654435761
_LN2 = np.log(2.0)


def grams_of(words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(code, word): for each byte of each word and its closing blank, the bytes before it, the
    last one first, and the byte itself in one number; and which word it is of. The end has no
    blank behind it."""
    flat = np.frombuffer("".join(w + " " for w in words.to_pylist()).encode(), dtype=np.uint8)
    lengths = np.diff(np.flatnonzero(np.concatenate([[True], flat == _BLANK])))
    word = np.repeat(np.arange(len(lengths)), lengths)
    start = np.cumsum(lengths) - lengths
    at = np.arange(len(flat)) - np.repeat(start, lengths)
    code = np.zeros(len(flat), dtype=np.int64)
    for back in range(1, DEPTH + 1):
        before = np.full(len(flat), _BLANK, dtype=np.int64)
        inside = np.flatnonzero(at >= back)
        before[inside] = flat[inside - back]
        code = code << 8 | before
    code = code << 8 | flat
    ended = (flat == _BLANK) & (at == 1)
    ended[ended] = flat[np.flatnonzero(ended) - 1] == ord(END)
    return code[~ended], word[~ended]


def said(text: str, raw: bytes) -> tuple[bytes, int]:
    """A text as its words, A-Z lower-cased and each with a blank behind it, and its end; packed,
    and its size."""
    plain = b"".join(w + b" " for w in raw.translate(matrix.LOWER).split()) + END.encode()
    return _CODEC.compress(plain, asbytes=True), len(plain)


_SAID = T.StructType([T.StructField("said", T.BinaryType()), T.StructField("size", T.LongType())])


class Texts:
    """The texts of a shard behind one another, each with blanks before it."""

    def __init__(self, packed: pa.Array, sizes: np.ndarray):
        self.size = sizes + DEPTH
        self.starts = np.cumsum(self.size) - self.size
        plain = (
            b" " * DEPTH + _CODEC.decompress(p.as_py(), int(n), asbytes=True)
            for p, n in zip(packed, sizes, strict=True)
        )
        self.flat = np.frombuffer(b"".join(plain), dtype=np.uint8)

    def pieces(self) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """(gram, text, first): the grams of a stretch of the texts, which texts have a part in it, and
        where the grams of each begin; the blanks before the texts have none."""
        for low in range(0, len(self.flat), BYTES_AT_ONCE):
            high = min(low + BYTES_AT_ONCE, len(self.flat))
            begun = int(np.searchsorted(self.starts, low, side="right")) - 1
            end = int(np.searchsorted(self.starts, high))
            text = np.arange(begun, end)
            first = np.minimum(np.maximum(self.starts[begun:end] + DEPTH, low), high)
            last = np.minimum(self.starts[begun:end] + self.size[begun:end], high)
            length = last - first
            text, first, length = (a[length > 0] for a in (text, first, length))
            whole = np.cumsum(length)
            at = np.arange(length.sum()) + np.repeat(first - (whole - length), length)
            # The bytes before the first ones of a stretch are those of the stretch before.
            least = max(low, DEPTH)
            code = np.zeros(high - least, dtype=np.int64)
            for back in (*range(1, DEPTH + 1), 0):
                code <<= 8
                code |= self.flat[least - back : high - back]
            yield code[at - least], text, whole - length


def _firsts(ascending: np.ndarray) -> np.ndarray:
    """Where each different value begins."""
    return np.flatnonzero(np.concatenate([[True], ascending[1:] != ascending[:-1]]))


def added_up(keys: np.ndarray, *values: np.ndarray) -> tuple[np.ndarray, ...]:
    """The different keys, ascending, and the sums of each one's values."""
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    first = _firsts(keys) if len(keys) else order
    return keys[first], *(np.add.reduceat(v[order], first) if len(keys) else v for v in values)


def learned(codes: np.ndarray, learn: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The different grams, ascending, and how often each stands where ``learn`` is 1, not 0. Both
    are sorted as one number, several times faster than the order of grams is found."""
    if not len(codes):
        return codes, learn
    both = np.sort(codes << 1 | learn)
    grams = both >> 1
    first = _firsts(grams)
    return grams[first], np.add.reduceat(both & 1, first)


def values_of(codes: np.ndarray, grams: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Each code's value; ``grams`` are ascending and have all codes. Every different code is looked
    up once, in order, so neighbouring searches touch the same memory."""
    order = np.argsort(codes)
    codes = codes[order]
    first = _firsts(codes)
    times = np.diff(np.append(first, len(codes)))
    found = np.empty(len(codes), dtype=values.dtype)
    found[order] = np.repeat(values[np.searchsorted(grams, codes[first])], times)
    return found


def log_gamma(x: np.ndarray) -> np.ndarray:
    """ln of the gamma function for x > 0: Stirling's series for x + 8, taken back step by step."""
    product = np.ones_like(x)
    for k in range(8):
        product = product * (x + k)
    y = x + 8.0
    square = 1.0 / (y * y)
    terms = 1 / 1260 - square * (1 / 1680 - square / 1188)
    series = (1 / 12 - square * (1 / 360 - square * terms)) / y
    return (y - 0.5) * np.log(y) - y + 0.5 * np.log(2 * np.pi) + series - np.log(product)


def block(zeros: np.ndarray, ones: np.ndarray) -> np.ndarray:
    """ln of the Krichevsky-Trofimov probability of that many zeros and ones in any order."""
    a, b = zeros.astype(np.float64), ones.astype(np.float64)
    return log_gamma(a + 0.5) + log_gamma(b + 0.5) - log_gamma(a + b + 1.0) - np.log(np.pi)


def weigh(zeros: np.ndarray, ones: np.ndarray, below: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(ln of the weighted probability, share of the context itself in the next estimate) from a
    context's counts and the sum of what its extensions weigh."""
    own = block(zeros, ones)
    both = np.logaddexp(own, below)
    return both - _LN2, np.exp(own - both)


def estimate(zeros: np.ndarray, ones: np.ndarray) -> np.ndarray:
    """Probability of a one."""
    return (ones + 0.5) / (zeros + ones + 1.0)


_STEPS = np.arange(8)


def decisions(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(keys, bits), eight for each gram: its context and the node of the decision, and which way
    its last byte goes there."""
    byte = codes & 0xFF
    node = (1 << _STEPS) | (byte[:, None] >> (8 - _STEPS))
    bit = (byte[:, None] >> (7 - _STEPS)) & 1
    return (((codes >> 8) << 8)[:, None] | node).ravel(), bit.ravel()


def shorter(keys: np.ndarray) -> np.ndarray:
    """The keys without the oldest byte of their contexts."""
    return (keys >> 16) << 8 | (keys & 0xFF)


class Levels:
    """The part of the tree below its contexts of LATEST bytes that some sorted grams make."""

    def __init__(self, codes: np.ndarray, n: np.ndarray):
        every, bits = decisions(codes)
        times = np.repeat(n, 8)
        keys, zeros, ones = added_up(every, times * (1 - bits), times * bits)
        own = block(zeros, ones)
        #: From the longest contexts up: (keys, whether counted, estimate, share of the context).
        self.levels = [(keys, zeros + ones > 0, estimate(zeros, ones), np.ones(len(keys)))]
        for _ in range(DEPTH - LATEST):
            keys, zeros, ones, below = added_up(shorter(keys), zeros, ones, own)
            own, share = weigh(zeros, ones, below)
            self.levels.append((keys, zeros + ones > 0, estimate(zeros, ones), share))
        self.top = (keys, zeros, ones, own)

    def code_lengths(self, above: np.ndarray, state: np.ndarray, codes: np.ndarray) -> np.ndarray:
        """Bits that each gram's last byte costs. ``state`` belongs to the keys ``above`` of the
        contexts one byte shorter than LATEST: what all depths so far estimate, what share longer
        ones have, and the last estimate."""
        for keys, counted, guess, share in reversed(self.levels):
            at = np.searchsorted(above, shorter(keys))
            mixed, left, last = state[:, at]
            guess = np.where(counted, guess, last)
            state = np.stack([mixed + left * share * guess, left * (1 - share), guess])
            above = keys
        keys, bits = decisions(codes)
        one = state[0, np.searchsorted(above, keys)]
        return -np.log2(np.where(bits == 1, one, 1 - one)).reshape(-1, 8).sum(axis=1)


def whole_groups(
    batches: Iterator[pa.RecordBatch], key, least: int = ROWS_AT_ONCE
) -> Iterator[pa.Table]:
    """Tables of at least so many rows (but for the last) that end where a group ends; the batches
    are sorted by group, and ``key`` gives a table's groups as an array."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if batch.num_rows:
            held.append(batch)
        if sum(b.num_rows for b in held) < least:
            continue
        table = pa.Table.from_batches(held)
        groups = key(table)
        cut = int(np.flatnonzero(groups != groups[-1])[-1]) + 1 if groups[0] != groups[-1] else 0
        if cut:
            yield table.slice(0, cut)
            held = table.slice(cut).combine_chunks().to_batches()
    if held:
        yield pa.Table.from_batches(held)


def _latest(codes: np.ndarray) -> np.ndarray:
    return codes >> 8 * (DEPTH + 1 - LATEST)


def _numpy(table: pa.Table) -> list[np.ndarray]:
    return [c.to_numpy() for c in table.columns]


def count_grams(words: DataFrame) -> DataFrame:
    """(gram, n) of the words (word, n), those of words that never stood in training with n 0."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            codes, word = grams_of(batch.column(0))
            found = added_up(codes, batch.column(1).to_numpy()[word])
            yield pa.RecordBatch.from_arrays([pa.array(f) for f in found], ["gram", "n"])

    counted = words.select("word", "n").mapInArrow(count, "gram long, n long")
    return counted.groupBy("gram").agg(F.sum("n").alias("n"))


def _packed(values: np.ndarray) -> bytes:
    """Numbers of eight bytes, packed; the first bytes of all, then the second ones and so on."""
    return _CODEC.compress(values.view(np.uint8).reshape(-1, 8).T.tobytes(), asbytes=True)


def _unpacked(packed: pa.Scalar, size: int, dtype: type) -> np.ndarray:
    planes = np.frombuffer(_CODEC.decompress(packed.as_py(), 8 * size, asbytes=True), np.uint8)
    return np.ascontiguousarray(planes.reshape(8, size).T).view(dtype).ravel()


def _ascending(packed: pa.Scalar, size: int) -> np.ndarray:
    return np.cumsum(_unpacked(packed, size, np.int64))


def _range_of(grams: DataFrame, ranges: int) -> DataFrame:
    """With the range of each gram, as ``_ranges`` has it."""
    top = F.shiftright("gram", 8 * (DEPTH + 1 - LATEST))
    return grams.withColumn("range", F.pmod(F.shiftright(top * F.lit(_SPREAD), 12), F.lit(ranges)))


def _ranges(grams: np.ndarray, ranges: int) -> np.ndarray:
    return (_latest(grams) * _SPREAD >> 12) % ranges


_LISTS = "home long, range long, size long, grams binary, ns binary"


def text_grams(shards: DataFrame, ranges: int) -> DataFrame:
    """(home, range, size, grams, ns): the different grams of the texts of each shard, ascending,
    and how often they stand in texts to learn from, packed by ranges of their contexts."""

    def lists(number: int, rows: pa.StructArray) -> pa.RecordBatch:
        learn, packed, sizes = rows.flatten()
        weight = learn.to_numpy(zero_copy_only=False).astype(np.int64)
        found = []
        for code, text, first in Texts(packed, sizes.to_numpy()).pieces():
            lengths = np.diff(np.append(first, len(code)))
            found.append(learned(code, np.repeat(weight[text], lengths)))
        gram, n = added_up(*(np.concatenate(c) for c in zip(*found, strict=True)))
        home = _ranges(gram, ranges)
        order = np.argsort(home, kind="stable")
        cuts = np.searchsorted(home[order], np.arange(ranges + 1))
        parts = [(k, order[i:j]) for k, (i, j) in enumerate(zip(cuts, cuts[1:])) if j > i]
        columns = [
            pa.array([number] * len(parts), pa.int64()),
            pa.array([k for k, _ in parts], pa.int64()),
            pa.array([len(at) for _, at in parts], pa.int64()),
            pa.array([_packed(np.diff(gram[at], prepend=0)) for _, at in parts], pa.binary()),
            pa.array([_packed(n[at]) for _, at in parts], pa.binary()),
        ]
        return pa.RecordBatch.from_arrays(columns, ["home", "range", "size", "grams", "ns"])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for number, rows in zip(batch.column(0), batch.column(1), strict=True):
                yield lists(number.as_py(), rows.values)

    rows = F.transform("rows", lambda r: F.struct(r["learn"], r["said"], r["size"]))
    return shards.select("shard", rows.alias("rows")).mapInArrow(count, _LISTS)


def count_lists(lists: DataFrame) -> DataFrame:
    """(gram, n) over all shards, range by range."""

    def add(table: pa.Table) -> pa.Table:
        sizes = table.column("size").to_pylist()
        grams = [_ascending(p, n) for p, n in zip(table.column("grams"), sizes, strict=True)]
        ns = [_unpacked(p, n, np.int64) for p, n in zip(table.column("ns"), sizes, strict=True)]
        found = added_up(np.concatenate(grams), np.concatenate(ns))
        return pa.table([pa.array(f) for f in found], ["gram", "n"])

    return lists.groupBy("range").applyInArrow(add, "gram long, n long")


def priced_lists(lists: DataFrame, bits: DataFrame, ranges: int) -> DataFrame:
    """(home, size, grams, costs): the lists of the shards with the code lengths of their grams."""

    def look_up(own: pa.Table, found: pa.Table) -> pa.Table:
        gram, cost = (found.column(c).to_numpy() for c in ("gram", "bits"))
        order = np.argsort(gram)
        gram, cost = gram[order], cost[order]
        sizes = own.column("size").to_pylist()
        costs = [
            _packed(cost[np.searchsorted(gram, _ascending(p, n))])
            for p, n in zip(own.column("grams"), sizes, strict=True)
        ]
        columns = [*(own.column(c) for c in ("home", "size", "grams")), pa.array(costs, pa.binary())]
        return pa.table(columns, ["home", "size", "grams", "costs"])

    asked = lists.select("range", "home", "size", "grams").groupBy("range")
    given = _range_of(bits, ranges).groupBy("range")
    return asked.cogroup(given).applyInArrow(look_up, "home long, size long, grams binary, costs binary")


def text_bits(shards: DataFrame, priced: DataFrame) -> DataFrame:
    """(home, bits): what each text of a shard costs, from the shard's priced lists."""

    def price(own: pa.Table, found: pa.Table) -> pa.Table:
        sizes = found.column("size").to_pylist()
        gram = np.concatenate([_ascending(p, n) for p, n in zip(found.column("grams"), sizes, strict=True)])
        cost = np.concatenate(
            [_unpacked(p, n, np.float64) for p, n in zip(found.column("costs"), sizes, strict=True)]
        )
        order = np.argsort(gram)
        gram, cost = gram[order], cost[order]
        packed, size = own.column("rows").combine_chunks().flatten().flatten()
        whole = np.zeros(len(size))
        for code, text, first in Texts(packed, size.to_numpy()).pieces():
            if len(code):
                whole[text] += np.add.reduceat(values_of(code, gram, cost), first)
        listed = pa.ListArray.from_arrays(pa.array([0, len(whole)], pa.int32()), pa.array(whole))
        return pa.table([own.column("shard"), listed], ["home", "bits"])

    rows = F.transform("rows", lambda r: F.struct(r["said"], r["size"]))
    left = shards.select("shard", rows.alias("rows")).groupBy("shard")
    return left.cogroup(priced.groupBy("home")).applyInArrow(price, "home long, bits array<double>")


def _by_subtree(grams: DataFrame) -> DataFrame:
    latest = F.shiftright("gram", 8 * (DEPTH + 1 - LATEST))
    return grams.withColumn("top", latest)


def _upper(grams: DataFrame) -> DataFrame:
    """(ctx, node, mixed, rest, guess) of all contexts one byte shorter than LATEST."""

    def climb(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in whole_groups(batches, lambda t: _latest(t.column("gram").to_numpy())):
            keys, *values = Levels(*_numpy(table)).top
            arrays = [pa.array(a) for a in (keys >> 8, keys & 0xFF, *values)]
            yield pa.RecordBatch.from_arrays(arrays, ["ctx", "node", "zeros", "ones", "weight"])

    counted = "ctx long, node long, zeros long, ones long, weight double"
    sorted_grams = _by_subtree(grams).repartition("top").sortWithinPartitions("gram").select("gram", "n")
    level = stored(sorted_grams.mapInArrow(climb, counted), "contexts")

    def weighed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ctx, node, zeros, ones, below = (c.to_numpy() for c in batch.columns)
            weight, share = weigh(zeros, ones, below)
            arrays = [pa.array(a) for a in (ctx, node, zeros, ones, weight, share)]
            yield pa.RecordBatch.from_arrays(arrays, ["ctx", "node", "zeros", "ones", "weight", "share"])

    every = F.col("zeros") + F.col("ones")
    guess = F.when(every > 0, (F.col("ones") + 0.5) / (every + 1.0))
    levels = []
    for _ in range(LATEST):
        above = level.groupBy(F.shiftright("ctx", 8).alias("ctx"), "node").agg(
            *(F.sum(c).alias(c) for c in ("zeros", "ones", "weight"))
        )
        level = stored(above.mapInArrow(weighed, counted + ", share double"), "contexts")
        levels.append(level.select("ctx", "node", guess.alias("guess"), "share"))

    mixed = levels[-1].withColumn("guess", F.coalesce("guess", F.lit(0.5)))
    mixed = mixed.select(
        "ctx", "node", (F.col("share") * F.col("guess")).alias("mixed"), (1 - F.col("share")).alias("rest"), "guess"
    )
    for level in reversed(levels[:-1]):
        above = mixed.select(
            F.col("ctx").alias("up"), F.col("node").alias("at"), "mixed", "rest", F.col("guess").alias("last")
        )
        own = level.join(above, (F.shiftright("ctx", 8) == F.col("up")) & (F.col("node") == F.col("at")))
        own = own.withColumn("guess", F.coalesce("guess", "last"))
        mixed = own.select(
            "ctx",
            "node",
            (F.col("mixed") + F.col("rest") * F.col("share") * F.col("guess")).alias("mixed"),
            (F.col("rest") * (1 - F.col("share"))).alias("rest"),
            "guess",
        )
    return mixed


def code_lengths(grams: DataFrame) -> DataFrame:
    """(gram, bits): what the last byte of each counted gram costs behind the bytes before it."""
    above = _upper(grams)
    # One row for each decision at the context above a subtree: it stands before the grams of the
    # subtree, as it has no gram.
    reach = _by_subtree(grams)
    tops = reach.select("top").distinct()
    upper = tops.join(above, F.shiftright("top", 8) == F.col("ctx")).select(
        "top",
        F.lit(-1).cast("long").alias("gram"),
        F.lit(0).cast("long").alias("n"),
        "node",
        "mixed",
        "rest",
        "guess",
    )
    lower = reach.select(
        "top",
        "gram",
        "n",
        F.lit(0).cast("long").alias("node"),
        *(F.lit(0.0).alias(c) for c in ("mixed", "rest", "guess")),
    )

    def descend(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in whole_groups(batches, lambda t: t.column("top").to_numpy()):
            top, gram, n, node, *state = _numpy(table)
            given, asked = np.flatnonzero(gram < 0), np.flatnonzero(gram >= 0)
            # Subtrees next to each other have the same rows above them.
            keys = (top[given] >> 8) << 8 | node[given]
            above, first = np.unique(keys, return_index=True)
            state = np.stack(state)[:, given[first]]
            found = Levels(gram[asked], n[asked]).code_lengths(above, state, gram[asked])
            yield pa.RecordBatch.from_arrays([pa.array(gram[asked]), pa.array(found)], ["gram", "bits"])

    both = upper.unionByName(lower).repartition("top").sortWithinPartitions("top", "gram")
    return both.mapInArrow(descend, "gram long, bits double")


def word_bits(words: DataFrame, bits: DataFrame) -> DataFrame:
    """(word, n, bits) from the words (word, n) and the code lengths of their grams."""
    lists = -(-words.count() // WORDS_AT_ONCE) or 1
    placed = words.select(F.pmod(F.xxhash64("word"), F.lit(lists)).alias("home"), "word", "n")

    def asked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in whole_groups(batches, lambda t: t.column("home").to_numpy(), least=1):
            homes, column = table.column("home").to_numpy(), table.column("word").combine_chunks()
            starts = np.flatnonzero(np.concatenate([[True], homes[1:] != homes[:-1]]))
            for begun, end in zip(starts, [*starts[1:], len(homes)], strict=True):
                grams = np.unique(grams_of(column.slice(begun, end - begun))[0])
                home = np.full(len(grams), homes[begun])
                yield pa.RecordBatch.from_arrays([pa.array(home), pa.array(grams)], ["home", "gram"])

    grouped = placed.select("home", "word").repartition("home").sortWithinPartitions("home")
    wanted = grouped.mapInArrow(asked, "home long, gram long")
    brought = wanted.join(bits, "gram").select(F.col("home").alias("to"), "gram", "bits")

    def added(own: pa.Table, found: pa.Table) -> pa.Table:
        gram, cost = found.column("gram").to_numpy(), found.column("bits").to_numpy()
        order = np.argsort(gram)
        codes, word = grams_of(own.column("word").combine_chunks())
        each = cost[order[np.searchsorted(gram[order], codes)]]
        whole = np.bincount(word, weights=each, minlength=own.num_rows)
        return pa.table([own.column("word"), own.column("n"), pa.array(whole)], ["word", "n", "bits"])

    return (
        placed.groupBy("home")
        .cogroup(brought.groupBy("to"))
        .applyInArrow(added, "word string, n long, bits double")
    )


def score(
    docs: DataFrame, folds: int = FOLDS, held_out: int = HELD_OUT, across: bool = False
) -> DataFrame:
    """One row per row of ``docs``: doc_id, held_out, n_tokens, n_known, train_tokens, base_score
    (log10 by word counts, one added), score (log10 by the weighted trees), n_bytes (of the
    tokens with their blanks and the end) and bits_per_byte. Contexts reach ``across`` words, as
    they do in context-tree weighting of a text, or end where the token begins."""
    remainder = fold("doc_id", folds)
    shards = matrix.encode(
        docs.select(
            F.col("doc_id").cast("long").alias("doc_id"),
            F.coalesce(remainder == held_out, F.lit(False)).alias("held_out"),
            F.coalesce(remainder != held_out, F.lit(False)).alias("learn"),
            "text",
        ),
        lower=True,
        closing=END,
        counted="learn",
        facts=said if across else None,
        fact_fields=_SAID if across else None,
        codec="zstd" if across else None,
    )
    counted = matrix.local_words(shards).groupBy("word").agg(F.sum("n").alias("n"))
    words = stored(counted, "words")
    if across:
        ranges = -(-shards.count() // SHARDS_A_RANGE) or 1
        lists = stored(text_grams(shards, ranges), "lists")
        bits = stored(code_lengths(stored(count_lists(lists), "grams")), "bits")
        costs = stored(text_bits(shards, priced_lists(lists, bits, ranges)), "costs")
        row = F.transform(
            "rows",
            lambda r, i: F.struct(r["doc_id"], r["held_out"], F.get("bits", i).alias("bits"), r["size"]),
        )
        # Eight bytes a text: a small side, of which the plan knows the size.
        rows = shards.join(costs, F.col("shard") == F.col("home")).withColumn("rows", row)
        values = words.select("word", "n")
    else:
        bits = stored(code_lengths(stored(count_grams(words), "grams")), "bits")
        known = stored(word_bits(words, bits), "known")
        rows = shards
        # The end is one byte, a word has a blank behind it.
        size = F.octet_length("word") + F.when(F.col("word") == END, 0).otherwise(1)
        values = known.select("word", "n", "bits", size.cast("long").alias("size"))
    totals = words.agg(
        F.coalesce(F.sum("n"), F.lit(0)), F.coalesce(F.sum((F.col("n") > 0).cast("long")), F.lit(0))
    )
    tokens, kinds = totals.first()
    layout = T.StructType.fromDDL(SCORES)

    def rate(own: matrix.Rows) -> pa.Table:
        counts, n = own.counts.astype(np.int64), own.values["n"]
        base = np.log10((n + 1) / (tokens + kinds + 1))
        if across:
            cost, size = (own.rows.field(c).to_numpy() for c in ("bits", "size"))
        else:
            cost, size = (own.sums(counts * own.values[c][own.slots]) for c in ("bits", "size"))
        columns = [
            own.rows.field("doc_id"),
            own.rows.field("held_out"),
            own.sums(counts),
            own.sums(counts * (n > 0)[own.slots]),
            np.full(len(own.rows), tokens),
            own.sums(counts * base[own.slots]),
            -cost * np.log10(2.0),
            size,
            cost / size,
        ]
        return pa.table([c if isinstance(c, pa.Array) else pa.array(c) for c in columns], layout.names)

    return matrix.resolve(rows, matrix.brought(shards, values), rate, layout)
