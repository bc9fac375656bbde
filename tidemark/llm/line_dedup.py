"""Line dedup: fuzzy lines across all documents; one occurrence of each connected group stays.

Lines are normalised to their lower-cased runs of word characters; lines that are equal when normalised are one node. A node's
SimHash has BLOCKS blocks of 64 bits. By the pigeonhole principle two SimHashes that differ in fewer than BLOCKS blocks agree
in one, so SimHashes are joined on every block and lines that meet are compared.

A block is the SimHash of a sample of the line's features, not of all of them: a SimHash over a whole line moves by a tenth of its bits
or more when one word of ten changes, and no block long enough to be selective survives that (the README has figures). The
features are runs of GRAM characters; a block's sample is the least of either half of the line, by hashes of its own, so that similar lines
draw the same sample with a probability that follows from their similarity, whatever else they hold, and lines that share one passage
only seldom do. What is drawn must stand at places that so few edits can bring about. Short lines, of which few runs survive an
edit, have further blocks: lines of SHORT_WORDS[0] to SHORT_WORDS[1] words the line without each of its words, and lines of
PARTED_WORDS[0] to PARTED_WORDS[1] words every choice of PARTS - 2 of their PARTS parts, of which two replaced words spare one.

Lines that share a block form a cluster. ``clusters.connect_members`` links all pairs whose edit similarity
(1 - Levenshtein distance / longer length) is SIMILARITY or more, as far as they connect something new, in tiles of bounded
size. Of each connected group of links the occurrence with the smallest (doc_id, text hash, line number) stays.

Defined results: a null text stays null and an empty one empty; lines without word characters stay; a text without any line of
FULL_WORDS words or more takes no part and stays as it is, so that a document of a few common words is no copy of a line
elsewhere; of equal lines in one document the first stays; repeated rows are treated alike, as one occurrence; a null doc_id
comes before all others; line ends are line feeds and all other characters of kept lines stay as they are; a text may have any
length, and a task holds one batch of texts; columns of any other name pass through untouched; an empty table gives no rows.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.clusters import connect_members, connected_components, with_blocks
from tidemark.llm.ngram_join import perhaps_wanted
from tidemark.llm.texts import map_batches, to_batch
from tidemark.session import Scratch, durable

FULL_WORDS = 5
SIMILARITY = 0.8
#: Longer grams make chance meetings fewer, more blocks find more; a sample has one gram of each of SAMPLE equal parts of the line.
#: The README has the recall by length.
GRAM = 12
SAMPLE = 2
BLOCKS = 16
SHORT_WORDS = (4, 10)
PARTED_WORDS = (7, 12)
PARTS = 4
_CHOICES = list(combinations(range(PARTS), PARTS - 2))
_WORD = re.compile(r"\w+")


def normalise(line: str) -> list[str]:
    return _WORD.findall(line.lower())


def _letters() -> np.ndarray:
    """Which code points belong to words, as the word pattern has it."""
    return np.fromiter((chr(c).isalnum() or c == 95 for c in range(0x110000)), bool, 0x110000)


_IN_WORD = _letters()
#: Characters of texts that are hashed at once, so few that their arrays' memory is used again and again; a longer text is hashed alone.
_TOGETHER = 1 << 16
_BASE = 0x9E3779B97F4A7C15
_SEEDS = (0xBF58476D1CE4E5B9, 0x94D049BB133111EB, 0xD6E8FEB86659FD93)


def _powers(base: int, n: int) -> np.ndarray:
    """1, base, base squared and so on, modulo 2 to the 64th."""
    out = np.empty(n, np.uint64)
    out[0] = 1
    done = 1
    while done < n:
        step = min(done, n - done)
        out[done : done + step] = out[:step] * np.uint64(pow(base, done, 1 << 64))
        done += step
    return out


def _mix(x: np.ndarray, seed: int) -> np.ndarray:
    """A bijection that spreads all bits."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(seed)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(_SEEDS[1])
    return x ^ (x >> np.uint64(31))


#: The low bits of a block, which hold where the first of its sample stands in the line, or that it stands nowhere or far behind.
_NO_PLACE = np.uint64(0xFFFF)
#: Odd factors, each of which puts the grams' hashes in another order.
_ORDERS = (_powers(_BASE, BLOCKS * SAMPLE + 1)[1:] >> np.uint64(32)).astype(np.uint32) | np.uint32(1)
_NONE = np.empty(0, np.int64), np.empty(0, np.int64), np.empty((0, 2), np.uint64), np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.int64)


class LineHasher:
    """Keys, lengths and blocks of all lines of a text, in vector operations over its characters.

    A word's hash is a polynomial of its characters: with Q the inverse of P, (S_end - S_start) * P^end for prefix sums S
    of c_i Q^i does not depend on where the word stands. A key is 128 bits of two polynomials of mixed word hashes.
    """

    def __init__(self):
        self.size = 0
        self.grow(_TOGETHER)

    def grow(self, n: int) -> None:
        if n > self.size:
            self.size = n
            self.up, self.down = _powers(_BASE, n + 1), _powers(pow(_BASE, -1, 1 << 64), n + 1)
            self.places = [_powers(seed | 1, n + 1) for seed in _SEEDS[:2]]

    def lines(self, texts: list[str]) -> tuple[np.ndarray, ...]:
        """(numbers of texts, line numbers, keys as rows of two, lengths, numbers of blocks, blocks one line after the other) of the lines that take part."""
        text = "\n".join(texts)
        first_line = np.cumsum([0] + [x.count("\n") + 1 for x in texts[:-1]])
        points = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)
        self.grow(len(points))
        inside = np.zeros(len(points) + 2, bool)
        inside[1:-1] = _IN_WORD[points]
        starts, ends = np.flatnonzero(~inside[:-1] & inside[1:]), np.flatnonzero(inside[:-1] & ~inside[1:])
        of_line = np.searchsorted(np.flatnonzero(points == 10), starts)
        first = np.flatnonzero(np.diff(of_line, prepend=-1))
        counts = np.diff(first, append=len(starts))
        if not len(first):
            return _NONE
        number = of_line[first]
        row = np.searchsorted(first_line, number, side="right") - 1
        most = np.zeros(len(texts), np.int64)
        np.maximum.at(most, row, counts)
        takes_part = most[row] >= FULL_WORDS
        sums = np.zeros(len(points) + 1, np.uint64)
        np.cumsum((points.astype(np.uint64) + np.uint64(1)) * self.down[: len(points)], out=sums[1:])
        words = _mix((sums[ends] - sums[starts]) * self.up[ends], _SEEDS[0])
        at = np.arange(len(words)) - np.repeat(first, counts)
        placed = [_mix(words, seed) * place[at] for seed, place in zip(_SEEDS[1:], self.places)]
        keys = np.stack([np.add.reduceat(x, first) for x in placed], axis=1)
        lengths, sampled = self._sampled(points, inside, starts[first], ends[first + counts - 1])
        short = takes_part & (counts >= SHORT_WORDS[0]) & (counts <= SHORT_WORDS[1])
        own = np.repeat(short, counts)
        spared = _spared(placed[0][own], counts[short], keys[short, 0])
        parted = takes_part & (counts >= PARTED_WORDS[0]) & (counts <= PARTED_WORDS[1])
        n_blocks = BLOCKS + np.where(short, counts, 0) + np.where(parted, len(_CHOICES), 0)
        blocks = np.empty(n_blocks.sum(), np.uint64)
        begin = np.cumsum(n_blocks) - n_blocks
        blocks[(begin[:, None] + np.arange(BLOCKS)).ravel()] = sampled.ravel()
        blocks[(np.repeat(begin, counts) + BLOCKS + at)[own]] = spared
        last = (begin + n_blocks)[parted] - len(_CHOICES)
        blocks[(last[:, None] + np.arange(len(_CHOICES))).ravel()] = _chosen_parts(placed[0], first[parted], counts[parted])
        own = np.repeat(takes_part, n_blocks)
        return row[takes_part], (number - first_line[row])[takes_part], keys[takes_part], lengths[takes_part], n_blocks[takes_part], blocks[own].view(np.int64)

    def _sampled(self, points: np.ndarray, inside: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Lengths and sampled blocks of the lines between these places, over characters as ``normalise`` leaves them, with one space after a word."""
        stays = inside[1:-1] | inside[:-2]
        moved = np.zeros(len(points) + 1, np.int64)
        np.cumsum(stays, out=moved[1:])
        plain = np.where(inside[1:-1], points, 32)[stays].astype(np.uint64) + np.uint64(1)
        begin, end = moved[starts], moved[ends]
        sums = np.zeros(len(plain) + 1, np.uint64)
        np.cumsum(plain * self.down[: len(plain)], out=sums[1:])
        grams = np.zeros(len(plain) + 1, np.uint64)
        if len(plain) >= GRAM:
            grams[: len(plain) - GRAM + 1] = _mix((sums[GRAM:] - sums[:-GRAM]) * self.up[GRAM : len(plain) + 1], _SEEDS[0])
        short = end - begin < GRAM  # one gram
        grams[begin[short]] = _mix((sums[end[short]] - sums[begin[short]]) * self.up[end[short]], _SEEDS[0])
        grams = (grams >> np.uint64(32)).astype(np.uint32)
        runs = np.maximum(1, end - begin - GRAM + 1)
        rows = np.empty((len(_ORDERS), len(begin)), np.uint32)
        at = np.empty((BLOCKS, len(begin)), np.uint64)
        for part in range(SAMPLE):  # the part's grams of all lines side by side, so that every order passes over them only
            offset = runs * part // SAMPLE
            sizes = np.maximum(1, runs * (part + 1) // SAMPLE - offset)
            first = np.cumsum(sizes) - sizes
            place = np.arange(sizes.sum()) + np.repeat(begin + offset - first, sizes)
            own = grams[place]
            if part:
                product = np.empty_like(own)
                for i in range(part, len(_ORDERS), SAMPLE):
                    rows[i] = np.minimum.reduceat(np.multiply(own, _ORDERS[i], out=product), first)
            else:  # with the place in the line: the hash times an order, modulo 2 to the 32nd, in the upper half
                own, place = own.astype(np.uint64) << np.uint64(32), (place - np.repeat(begin, sizes)).astype(np.uint64)
                product = np.empty_like(own)
                for i in range(0, len(_ORDERS), SAMPLE):
                    least = np.minimum.reduceat(np.bitwise_or(np.multiply(own, np.uint64(_ORDERS[i]), out=product), place, out=product), first)
                    rows[i], at[i // SAMPLE] = least >> np.uint64(32), least & np.uint64(0xFFFFFFFF)
        rows = rows.reshape(BLOCKS, SAMPLE, len(begin)).astype(np.uint64)
        return end - begin, (simhash_blocks(rows) & ~_NO_PLACE | np.minimum(at, _NO_PLACE)).T


def simhash_blocks(rows: np.ndarray) -> np.ndarray:
    """For (blocks, sample, lines) features the blocks' SimHashes: the bits that more than half of a sample's hashes have.

    A block's number is mixed in, so that only blocks of one number meet.
    """
    hashed = _mix(rows, _SEEDS[1])
    if rows.shape[1] <= 2:
        bits = np.bitwise_and.reduce(hashed, axis=1)
    else:
        ones = np.unpackbits(np.ascontiguousarray(hashed).view(np.uint8).reshape(*rows.shape, 8), axis=3, bitorder="little").sum(axis=1)
        bits = np.packbits(ones * 2 > rows.shape[1], axis=2, bitorder="little").view(np.uint64)[:, :, 0]
    return _mix(bits + np.arange(1, len(rows) + 1, dtype=np.uint64)[:, None] * np.uint64(_BASE), _SEEDS[2])


def _spared(placed: np.ndarray, counts: np.ndarray, wholes: np.ndarray) -> np.ndarray:
    """For every word the hash of its line without it; ``placed`` are the words' hashes times their places."""
    if not len(placed):
        return placed
    first = np.cumsum(counts) - counts
    before = np.cumsum(placed) - placed
    before = before - np.repeat(before[first], counts)
    after = np.repeat(wholes, counts) - before - placed
    back = np.uint64(pow(_SEEDS[0] | 1, -1, 1 << 64))  # the words behind move up by one place
    return _mix(before + after * back, _SEEDS[2]) | _NO_PLACE


def _chosen_parts(placed: np.ndarray, first: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """For every line the hashes of every choice of PARTS - 2 of its PARTS parts, by the words' hashes times their places."""
    sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(placed)))
    bounds = first[:, None] + counts[:, None] * np.arange(PARTS + 1) // PARTS
    parts = sums[bounds[:, 1:]] - sums[bounds[:, :-1]]
    chosen = np.stack([parts[:, list(c)].sum(axis=1) + np.uint64(i + 1) * np.uint64(_BASE >> 8) for i, c in enumerate(_CHOICES)], axis=1)
    return (_mix(chosen + counts[:, None].astype(np.uint64), _SEEDS[1]) | _NO_PLACE).ravel()


LINE_TYPES = {"doc_id": pa.int64(), "th": pa.int64(), "line": pa.int32(), "key": pa.binary(), "size": pa.int32(), "blocks": pa.binary()}
LINE_SCHEMA = "doc_id long, th long, line int, key binary, size int, blocks binary"
#: Lines of a batch at most, so that the bytes of their blocks have offsets of 32 bits.
_LINES_AT_ONCE = 1 << 20


def _lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    hasher = LineHasher()
    for batch in batches:
        texts, rows, size = [], [], 0
        for row, text in enumerate(batch.column("text")):
            text = text.as_py()
            if not text:
                continue
            if size + len(text) > _TOGETHER and texts:
                yield from _line_batches(batch, np.array(rows), *hasher.lines(texts))
                texts, rows, size = [], [], 0
            texts.append(text)
            rows.append(row)
            size += len(text)
        if texts:
            yield from _line_batches(batch, np.array(rows), *hasher.lines(texts))


def _line_batches(batch: pa.RecordBatch, rows: np.ndarray, row: np.ndarray, numbers: np.ndarray, keys: np.ndarray, sizes: np.ndarray, n_blocks: np.ndarray, blocks: np.ndarray) -> Iterator[pa.RecordBatch]:
    once = np.zeros(len(row), bool)
    once[np.unique(keys[:, 0], return_index=True)[1]] = True  # equal lines give their blocks once
    blocks, n_blocks = blocks[np.repeat(once, n_blocks)], np.where(once, n_blocks, 0)
    ends = np.cumsum(n_blocks)
    for lo in range(0, len(row), _LINES_AT_ONCE):
        hi = min(len(row), lo + _LINES_AT_ONCE)
        first = ends[lo] - n_blocks[lo]
        at = pa.array(rows[row[lo:hi]])
        key = _binary(16 * np.arange(hi - lo + 1), keys[lo:hi])
        own = _binary(8 * np.concatenate(([0], ends[lo:hi] - first)), blocks[first : ends[hi - 1]])
        columns = [batch.column("doc_id").take(at), batch.column("th").take(at), pa.array(numbers[lo:hi].astype(np.int32)), key, pa.array(sizes[lo:hi].astype(np.int32)), own]
        yield pa.RecordBatch.from_arrays(columns, names=list(LINE_TYPES))


def _binary(offsets: np.ndarray, values: np.ndarray) -> pa.Array:
    return pa.Array.from_buffers(pa.binary(), len(offsets) - 1, [None, pa.py_buffer(offsets.astype(np.int32)), pa.py_buffer(np.ascontiguousarray(values))])


def _longs(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The longs of all binary values one after the other, and how many each has."""
    offsets = np.frombuffer(column.buffers()[1], np.int32)[column.offset : column.offset + len(column) + 1]
    return np.frombuffer(column.buffers()[2] or b"", np.uint8)[offsets[0] : offsets[-1]].view(np.int64), np.diff(offsets) // 8


def edit_distance(a: str, b: str, limit: float = float("inf")) -> float:
    """Levenshtein distance, by bit vectors as long as the shorter string, without common ends; infinite as soon as it must exceed the limit.

    No path to the end costs less than where it crosses the diagonal that the end lies on.
    """
    i = 0
    while i < min(len(a), len(b)) and a[i] == b[i]:
        i += 1
    a, b = a[i:], b[i:]
    while a and b and a[-1] == b[-1]:
        a, b = a[:-1], b[:-1]
    if len(a) > len(b):
        a, b = b, a
    if not a:
        return len(b)
    where: dict[str, int] = {}
    for i, c in enumerate(a):
        where[c] = where.get(c, 0) | 1 << i
    full = (1 << len(a)) - 1
    up, down = full, 0
    for j, c in enumerate(b):
        if j & 31 == 31 and j > len(b) - len(a):
            above = (1 << len(a) - len(b) + j) - 1
            if j + (up & above).bit_count() - (down & above).bit_count() > limit:
                return float("inf")
        match = where.get(c, 0)
        diagonal = ((((match & up) + up) ^ up) | match | down) & full
        right_up = (down | (full ^ (diagonal | up))) << 1 | 1
        up = ((diagonal & up) << 1 | ~(diagonal | right_up)) & full
        down = right_up & diagonal
    return len(b) + up.bit_count() - down.bit_count()


def similar(a: str, b: str) -> bool:
    longer = max(len(a), len(b))
    allowed = (1 - SIMILARITY) * longer + 1e-9
    return abs(len(a) - len(b)) <= allowed and edit_distance(a, b, allowed) <= allowed


#: Texts that are compared with one at once, for the first, second and further times (fewer than the first: one by one), and their characters in all.
_AT_ONCE = (4, 32, 128)
_CHARS_AT_ONCE = 1 << 17
_LOOK_EVERY = 64
#: Rows of a tile whose 3-grams are only looked at where easy edits do not connect all.
_FEW = 16


def similar_among(text: str, others: list[str]) -> np.ndarray:
    """``similar(text, other)`` for each of the others, with the bit vectors of all of them in one number.

    Each has the bits of whole bytes with one at least to spare, which takes what is carried or moved out and is cleared.
    """
    sizes = np.array([len(x) for x in others])
    allowed = (1 - SIMILARITY) * np.maximum(sizes, len(text)) + 1e-9
    found = np.zeros(len(others), bool)
    number = np.flatnonzero(np.abs(sizes - len(text)) <= allowed)
    if not len(number):
        return found
    sizes, allowed = sizes[number], allowed[number]
    widths = sizes // 8 + 1
    begin = np.cumsum(widths) - widths
    points = np.full(widths.sum() * 8, 0xFFFFFFFF, np.uint32)
    at = np.arange(sizes.sum()) + np.repeat(begin * 8 - (np.cumsum(sizes) - sizes), sizes)
    points[at] = np.frombuffer("".join([others[i] for i in number]).encode("utf-32-le", "surrogatepass"), np.uint32)
    starts = np.zeros(len(points), bool)
    starts[begin * 8] = True

    def packed(bits: np.ndarray) -> int:
        return int.from_bytes(np.packbits(bits, bitorder="little").tobytes(), "little")

    def bits_of(x: int) -> np.ndarray:
        return np.frombuffer(x.to_bytes(widths.sum(), "little"), np.uint8)

    where = {c: packed(points == ord(c)) for c in set(text)}
    full, first = packed(points != 0xFFFFFFFF), packed(starts)
    up, down = full, 0
    for j, c in enumerate(text):
        if j % _LOOK_EVERY == _LOOK_EVERY - 1:
            rows = sizes - len(text) + j  # on the diagonal that the end lies on
            steps = np.concatenate(([0], np.cumsum(np.unpackbits(bits_of(up), bitorder="little").astype(np.int32) - np.unpackbits(bits_of(down), bitorder="little"))))
            here = np.maximum(rows, 0)
            alive = (rows <= 0) | (j + steps[begin * 8 + here] - steps[begin * 8] <= allowed)
            if not alive.any():
                return found
            if alive.sum() * 4 <= len(alive) * 3:
                own = np.repeat(alive, widths)
                up, down, full, first, *rest = [int.from_bytes(bits_of(x)[own].tobytes(), "little") for x in (up, down, full, first, *where.values())]
                where = dict(zip(where, rest))
                sizes, allowed, number, widths = sizes[alive], allowed[alive], number[alive], widths[alive]
                begin = np.cumsum(widths) - widths
        match = where[c]
        diagonal = ((((match & up) + up) ^ up) | match | down) & full
        right_up = (down | (full ^ (diagonal | up))) << 1 | first
        up = ((diagonal & up) << 1 | ((diagonal | right_up) ^ full)) & full
        down = right_up & diagonal
    ends = [np.add.reduceat(np.bitwise_count(bits_of(x)).astype(np.int64), begin) for x in (up, down)]
    found[number] = len(text) + ends[0] - ends[1] <= allowed
    return found


def easy_edits(p: list[str], q: list[str], limit: float) -> float:
    """Edits of an alignment of two lists of words that is easy to find, as a bound; infinite beyond the limit.

    Words are taken one by one; where they differ, the least number of words (LOOK_AHEAD at most) is replaced that leads to equal ones.
    """
    i = j = 0
    edits = 0
    while i < len(p) and j < len(q):
        if p[i] == q[j]:
            i += 1
            j += 1
            continue
        for x, y in _STEPS:
            if i + x < len(p) and j + y < len(q) and p[i + x] == q[j + y]:
                break
        else:
            break
        edits += max(sum(map(len, p[i : i + x])) + x, sum(map(len, q[j : j + y])) + y)
        if edits > limit:
            return float("inf")
        i, j = i + x, j + y
    edits += max(sum(map(len, p[i:])) + len(p) - i, sum(map(len, q[j:])) + len(q) - j)
    return edits if edits <= limit else float("inf")


LOOK_AHEAD = 5
_STEPS = [(x, n - x) for n in range(1, LOOK_AHEAD + 1) for x in sorted(range(n + 1), key=lambda x: abs(2 * x - n))]
_BINS = 4096


def near_lengths(texts: list[str]) -> np.ndarray:
    """Which pairs may be similar: an edit changes the length by one at most."""
    sizes = np.array([len(x) for x in texts])
    return np.triu(np.abs(sizes[:, None] - sizes[None, :]) <= (1 - SIMILARITY) * np.maximum(sizes[:, None], sizes[None, :]) + 1e-9, 1)


def perhaps_similar(texts: list[str]) -> np.ndarray:
    """Which pairs may be similar: of near lengths, and an edit takes and gives three 3-grams at most."""
    near = near_lengths(texts)
    sizes = np.array([len(x) for x in texts])
    allowed = (1 - SIMILARITY) * np.maximum(sizes[:, None], sizes[None, :]) + 1e-9
    if not near.any():
        return near
    points = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32)
    grams = (points[:-2] * np.uint32(961) + points[1:-1] * np.uint32(31) + points[2:]) * np.uint32(0x9E3779B1) >> np.uint32(20)
    ends = np.cumsum(sizes)
    runs = np.maximum(sizes - 2, 0)
    own = np.repeat(np.arange(len(texts)), runs)
    keys = np.sort(own * _BINS + grams[np.arange(runs.sum()) + np.repeat(ends - sizes - (np.cumsum(runs) - runs), runs)])
    shared = _common(keys // _BINS, _numbered(keys), len(texts))
    return near & (runs[:, None] + runs[None, :] - 2 * shared <= 6 * allowed)


def _numbered(keys: np.ndarray) -> np.ndarray:
    """For sorted numbers of rows and bins, the bin with how often the row has had it before."""
    new = np.flatnonzero(np.diff(keys, prepend=-1))
    return keys % _BINS + _BINS * (np.arange(len(keys)) - np.repeat(new, np.diff(new, append=len(keys))))


def _common(row: np.ndarray, feature: np.ndarray, n: int) -> np.ndarray:
    """How many features, of which a row has each once, every two of n rows share; by matrix products over those that two rows have at least."""
    order = np.argsort(feature, kind="stable")
    row, feature = row[order], feature[order]
    new = np.flatnonzero(np.diff(feature, prepend=-1))
    counts = np.diff(new, append=len(feature))
    column = np.repeat(np.cumsum(counts > 1) - 1, counts)
    several = np.repeat(counts > 1, counts)
    row, column = row[several], column[several]
    both = np.zeros((n, n), np.float32)
    for at in range(0, int(column[-1]) + 1 if len(column) else 0, 4096):
        lo, hi = np.searchsorted(column, (at, at + 4096))
        has = np.zeros((n, min(4096, int(column[-1]) + 1 - at)), np.float32)
        has[row[lo:hi], column[lo:hi] - at] = 1.0
        both += has @ has.T
    return both


def in_reach(rows: list[dict], texts: list[str]) -> np.ndarray:
    """Which pairs may be similar if what they share stays in place: the edits before it and behind it are at least as many as those parts differ in length."""
    sizes, bits, place = np.array([len(x) for x in texts]), np.array([row["bits"] for row in rows]), np.array([row["place"] for row in rows])
    shift = np.abs(place[:, None] - place[None, :])
    rest = sizes - place
    shift += np.abs(rest[:, None] - rest[None, :])
    nowhere = place == int(_NO_PLACE)
    unknown = (bits[:, None] != bits[None, :]) | nowhere[:, None] | nowhere[None, :]
    return unknown | (shift <= (1 - SIMILARITY) * np.maximum(sizes[:, None], sizes[None, :]) + 1e-9)


def _two_similar(one: dict, other: dict) -> bool:
    """``similar`` for the only two rows of a tile, by the tests that go before it for many, without matrices."""
    a, b = one["text"], other["text"]
    allowed = (1 - SIMILARITY) * max(len(a), len(b)) + 1e-9
    p, q = one["place"], other["place"]
    if one["bits"] == other["bits"] and int(_NO_PLACE) not in (p, q) and abs(p - q) + abs(len(a) - p - (len(b) - q)) > allowed:
        return False
    if abs(len(a) - len(b)) > allowed:
        return False
    return easy_edits(a.split(" "), b.split(" "), allowed) < float("inf") or bool(perhaps_similar([a, b])[0, 1]) and edit_distance(a, b, allowed) <= allowed


def compare_lines(rows: list[dict], blocks: list[int], same: bool) -> tuple[np.ndarray, np.ndarray]:
    """Links only as far as they connect something: a pair that is already connected needs no comparison."""
    if len(rows) == 2:
        linked = (same or blocks[0] != blocks[1]) and _two_similar(*rows)
        return np.full(2, int(linked)), np.array([0, 0 if linked else 1])
    texts = [row["text"] for row in rows]
    few = len(rows) <= _FEW
    near = (near_lengths(texts) if few else perhaps_similar(texts)) & in_reach(rows, texts)
    if not same:
        block = np.array(blocks)
        near &= block[:, None] != block[None, :]
    links = np.zeros(len(rows), np.int64)
    parent = list(range(len(rows)))

    def find(x: int) -> int:
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    def connect(test) -> None:
        for i, j in zip(*(x.tolist() for x in np.nonzero(near))):
            p, q = find(i), find(j)
            if p != q and test(i, j):
                parent[max(p, q)] = min(p, q)
                links[i] += 1
                links[j] += 1

    words = [text.split(" ") for text in texts]
    connect(lambda i, j: easy_edits(words[i], words[j], (1 - SIMILARITY) * max(len(texts[i]), len(texts[j]))) < float("inf"))
    if few and any(find(i) != find(j) for i, j in zip(*(x.tolist() for x in np.nonzero(near)))):
        near &= perhaps_similar(texts)
    for i in range(len(rows)):
        others, times = np.flatnonzero(near[i]), 0
        while len(others := np.array([j for j in others.tolist() if find(i) != find(j)], np.int64)):
            some = others[: max(1, min(_AT_ONCE[min(times, len(_AT_ONCE) - 1)], _CHARS_AT_ONCE // max(1, len(texts[i]))))].tolist()
            others, times = others[len(some) :], times + 1
            if len(some) < _AT_ONCE[0]:
                linked = [j for j in some if find(i) != find(j) and similar(texts[i], texts[j])]
            else:
                linked = [j for j, yes in zip(some, similar_among(texts[i], [texts[j] for j in some])) if yes]
            for j in linked:
                p, q = find(i), find(j)
                parent[max(p, q)] = min(p, q)
                links[i] += 1
                links[j] += 1
    return links, np.array([find(x) for x in range(len(rows))])


#: Blocks that are dealt out at once, and that a part of them has on average; parts are numbers of 16 bits.
_DEALT_AT_ONCE = 1 << 21
_PART = 1 << 19
_PARTS = 1 << 16


def _deal(parts: int):
    """(id, blocks) as few rows of many (id, block) for each part of the blocks, so that a shuffle moves no row for a block."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, blocks, size = [], [], 0

        def dealt() -> pa.RecordBatch:
            block, own = np.concatenate(blocks), np.concatenate(ids)
            part = ((block >> 16).view(np.uint64) * np.uint64(_BASE) >> np.uint64(40)) % np.uint64(parts)
            order = np.argsort(part.astype(np.uint16), kind="stable")
            ends = np.cumsum(np.bincount(part.astype(np.int64), minlength=parts))
            some = np.flatnonzero(np.diff(ends, prepend=0))
            offsets = 8 * np.concatenate(([0], ends[some]))
            return pa.RecordBatch.from_arrays([pa.array(some.astype(np.int32)), _binary(offsets, own[order]), _binary(offsets, block[order])], names=["part", "ids", "blocks"])

        for batch in batches:
            block, counts = _longs(batch.column("blocks"))
            ids.append(np.repeat(batch.column("id").to_numpy(zero_copy_only=False), counts))
            blocks.append(block.copy())
            size += len(block)
            if size >= _DEALT_AT_ONCE:
                yield dealt()
                ids, blocks, size = [], [], 0
        if size:
            yield dealt()

    return work


def _once(ids: np.ndarray, bits: np.ndarray, place: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Those whose bits others have too, each once, in the order of their bits."""
    order = np.argsort(bits)
    same = np.diff(bits[order]) == 0
    order = order[np.concatenate((same, [False])) | np.concatenate(([False], same))]
    order = order[np.lexsort((ids[order], bits[order]))]
    ids, bits, place = ids[order], bits[order], place[order]
    new = np.ones(len(ids), bool)
    new[1:] = (np.diff(ids) != 0) | (np.diff(bits) != 0)
    return ids[new], bits[new], place[new]


def _met(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For every part the ids whose blocks agree in their bits, with the least and the greatest id of these."""
    part, ids, blocks = None, [], []

    def close() -> Iterator[pa.RecordBatch]:
        block = np.concatenate(blocks)
        own, bits, place = _once(np.concatenate(ids), block >> 16, block & int(_NO_PLACE))
        if not len(own):
            return
        first = np.flatnonzero(np.diff(bits, prepend=~bits[0]))
        sizes = np.diff(first, append=len(bits))
        least, greatest = np.repeat(own[first], sizes), np.repeat(own[first + sizes - 1], sizes)
        meet = least < greatest
        columns = [pa.array(x[meet]) for x in (least, greatest, own, bits, place.astype(np.int32))]
        yield pa.RecordBatch.from_arrays(columns, names=["least", "greatest", "id", "bits", "place"])

    for batch in batches:
        for row, at in enumerate(batch.column("part").to_pylist()):
            if at != part and ids:
                yield from close()
                ids, blocks = [], []
            part = at
            ids.append(_longs(batch.column("ids").slice(row, 1))[0].copy())
            blocks.append(_longs(batch.column("blocks").slice(row, 1))[0].copy())
    if ids:
        yield from close()


def meetings(lines: DataFrame) -> DataFrame:
    """(cluster, id, bits, place) of the lines that share a block with others; sets of lines with the same least and greatest id are one cluster.

    ``bits`` and ``place`` are those of the first block that made the line a member. Blocks are dealt by their bits to parts of which
    a task holds one at a time, 16 bytes for a block, and sorted there.
    """
    n = int(lines.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    parts = min(_PARTS, max(4 * n, lines.count() * (BLOCKS + 1) // _PART))
    dealt = map_batches(lines.select(F.xxhash64("key").alias("id"), "blocks"), _deal(parts), "part int, ids binary, blocks binary")
    dealt = dealt.repartition(n, "part").sortWithinPartitions("part")
    met = map_batches(dealt, _met, "least long, greatest long, id long, bits long, place int")
    met = met.groupBy(F.xxhash64("least", "greatest").alias("cluster"), "id").agg(F.min(F.struct("bits", "place")).alias("at"))
    return met.select("cluster", "id", "at.bits", "at.place")


def _candidate_texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    types = {"node": pa.binary(), "text": pa.string()}
    for batch in batches:
        out: dict[str, list] = {name: [] for name in types}
        for text, wanted in zip(batch.column("text").to_pylist(), batch.column("wanted").to_pylist()):
            lines = (text or "").split("\n")
            out["node"] += [w["node"] for w in wanted]
            out["text"] += [" ".join(normalise(lines[w["line"]])) for w in wanted]
        yield to_batch(out, types)


def removed_lines(scratch: Scratch, documents: DataFrame) -> DataFrame:
    """(doc_id, th, removed): the numbers of the lines that go, for the documents that lose any; th is the text's hash."""
    given = documents.select("doc_id", "text", F.xxhash64("text").alias("th"))
    lines = scratch.keep(map_batches(given, _lines, LINE_SCHEMA))
    met = scratch.keep(meetings(lines))
    place = F.struct("doc_id", "th", "line")
    nodes = scratch.keep(lines.groupBy("key").agg(F.first("size").alias("size"), F.count("*").alias("n"), F.min(place).alias("one")))
    members = met.join(nodes.select(F.xxhash64("key").alias("id"), F.col("key").alias("node"), "size", "one"), "id").drop("id")
    members = scratch.keep(with_blocks(members))
    candidates = members.select("node", "one").dropDuplicates(["node"])
    wanted = candidates.groupBy(F.col("one.doc_id").alias("_id"), F.col("one.th").alias("_th")).agg(F.collect_list(F.struct(F.col("one.line").alias("line"), "node")).alias("wanted"))
    wanted = scratch.keep(wanted)
    held = perhaps_wanted(given, ["doc_id", "th"], wanted, ["_id", "_th"]).join(wanted.hint("shuffle_hash"), F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("th") == F.col("_th"))).select("text", "wanted")
    texts = map_batches(held, _candidate_texts, "node binary, text string").groupBy("node").agg(F.first("text").alias("text"))
    edges = connect_members(scratch, scratch.keep(members.drop("one").join(texts, "node")), compare_lines, ["text", "bits", "place"])
    groups = connected_components(edges).withColumnRenamed("node", "key")
    grouped = candidates.withColumnRenamed("node", "key").join(groups, "key")
    firsts = grouped.groupBy("root").agg(F.min("one").alias("first"))
    firsts = grouped.select("key", "root").join(firsts, "root").select("key", "first")
    alone = nodes.filter("n > 1").select("key", F.col("one").alias("first")).join(groups, "key", "left_anti")
    repeated = lines.select("key", "doc_id", "th", "line").join(scratch.keep(alone.unionByName(firsts)), "key")
    gone = repeated.filter(~place.eqNullSafe(F.col("first")))
    return gone.groupBy("doc_id", "th").agg(F.collect_set("line").alias("removed"))


def remove_lines(text, removed):
    """The text without the lines of these numbers, as a column."""
    kept = F.array_except(F.sequence(F.lit(0), F.size(F.split(text, "\n")) - 1), removed)
    return F.element_at(F.transform(F.array(F.split(text, "\n")), lambda lines: F.array_join(F.transform(F.array_sort(kept), lambda i: F.get(lines, i)), "\n")), 1)


def _cleaned(documents: DataFrame) -> tuple[DataFrame, str, str]:
    """``documents`` with cleaned text and, under names that no column has, the lines that went (null for none) and the number of lines before."""
    mark = f"_{uuid.uuid4().hex}"
    with Scratch(documents.sparkSession) as scratch:
        gone = durable(removed_lines(scratch, documents))
    gone = gone.select(F.col("doc_id").alias(f"{mark}_id"), F.col("th").alias(f"{mark}_th"), F.col("removed").alias(mark))
    joined = documents.join(gone.hint("shuffle_hash"), F.col("doc_id").eqNullSafe(F.col(f"{mark}_id")) & (F.xxhash64("text") == F.col(f"{mark}_th")), "left").drop(f"{mark}_id", f"{mark}_th")
    text = F.when(F.col(mark).isNull(), F.col("text")).otherwise(remove_lines(F.col("text"), F.col(mark)))
    n_lines = F.when(F.col("text").isNull() | (F.col("text") == ""), 0).otherwise(F.octet_length("text") - F.octet_length(F.replace(F.col("text"), F.lit("\n"), F.lit(""))) + 1)
    return joined.withColumns({"text": text, f"{mark}_n": n_lines.cast("long")}), mark, f"{mark}_n"


def dedup_lines(documents: DataFrame) -> DataFrame:
    """``documents`` with cleaned text, and n_lines and n_removed (in place of columns of these names)."""
    cleaned, removed, before = _cleaned(documents)
    return cleaned.withColumns({"n_lines": F.col(before), "n_removed": F.coalesce(F.size(removed), F.lit(0)).cast("long")}).drop(removed, before)


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's text after line dedup, with its numbers of lines before and of lines removed."""
    documents = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return dedup_lines(documents).select("doc_id", "n_lines", "n_removed", "text")


def stage_line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with cleaned texts and their lengths; those that lost every line go."""
    cleaned, mark, _ = _cleaned(docs)
    lost = F.col(mark).isNotNull()
    kept = cleaned.filter(~F.coalesce(lost & (F.trim(F.col("text")) == ""), F.lit(False)))
    return kept.withColumn("n_chars", F.when(lost, F.length("text").cast("long")).otherwise(F.col("n_chars"))).select(*docs.columns)
