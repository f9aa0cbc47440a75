"""A hierarchical Pitman-Yor language model, its seating sampled by Gibbs.

Every word that precedes another has a restaurant of its own (its customers are the tokens that
follow it), so contexts grow with the corpus.  The restaurants of words with like endings share a
parent, the restaurant of their class, a hash of the last two bytes; the classes share one
restaurant of single words, whose parent is uniform over the vocabulary and one unknown word.  A
table is a customer of the parent.  All words, pairs of words and counts come from all training
texts.

A sweep seats all customers of one dish in one restaurant anew, one by one, given the tables of
other dishes, which enter as totals from the sweep before.  Pairs of words are dealt by a hash of
both, so that no word, however frequent, lies in one task; a pair that occurs once has one table and
needs no seating.  What a pair's seating takes, the tables of its context and the probability of its
word in the class, is looked up by word.  The restaurants of classes and of single words are seated
by word: a sweep is one pass over the word table, which keeps the tables of the last sweeps.
Predictive probabilities of classes are averaged over them.

Words are told apart by 59 bits of a hash; the five low bits of a key hold the class of the word
before.  Pairs are told apart by 64 bits, words in lookups by 56.

Texts are read once, into chunks of tokens.  A chunk sends its distinct pairs to pieces of the range
of hashes; with the counts a piece notes where it found each chunk's pairs, so that they are sent
once for learning and for scoring.  Lookups work in bulk: words are dealt to pieces, whose values are
held by one task at a time, which answers lists of sorted words with the classes asked for.
"""

import functools

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from ..sources.shared import discard, materialise
from .common import (ARRAY_SCHEMA, LOWER, add_arrays, array_rows, crc_bucket, finish, text_slices,
                     shuffles_removed, small_batches, tidy)

CLASSES = 32
#: Sweeps over classes and words after the pairs have been seated for the last time.
SWEEPS = 4
#: Times that the pairs of words are seated, each after a short run of sweeps over classes and words
#: that have the tables of the time before.
ROUNDS = SWEEPS
#: Predictions are averaged over so many last sweeps.
SAMPLES = 2
CONCENTRATION = 1.0
#: Customers of one word beyond this number are seated in groups of a sixteenth of those seated.
SINGLY = 256
#: The pieces of pairs are counted in so many parts, one after the other: shuffled pairs take most
#: room.
PARTS = 2
#: Pieces of pairs for each piece of words.
TO_WORDS = 4
#: Distinct words that a task holds before it hands their sums on.
HELD = 1_000_000
#: Bytes of text for each piece of the range of hashes.
PIECE = 1 << 23
#: Tokens of a chunk of texts; a longer text comes alone.
CHUNK = 1_000_000
#: Rows of a batch where each row holds many keys or tokens.
WIDE = 256

_LOW = np.uint64(CLASSES - 1)
#: The end of a text; no word hashes to it but by a 59-bit collision.
END = np.uint64(xxhash.xxh3_64_intdigest(b"\n end of text \n")) & ~_LOW
#: What stands before the first word of a text.
START = np.uint64(xxhash.xxh3_64_intdigest(b"\n start of text \n")) & ~_LOW
_STEP = np.uint64(0x9E3779B97F4A7C15)
_ZIP = zstandard.ZstdCompressor(level=1)
_UNZIP = zstandard.ZstdDecompressor()
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_CLASS = (finish(np.arange(1 << 16, dtype=np.uint64)) % np.uint64(CLASSES - 1)
          + np.uint64(1)).astype(np.uint8)


def tokens(texts):
    """Keys (word and class of the word before) of all texts, the words before themselves, and each
    text's number of tokens.

    Every text ends with the end token.  Class 0 stands for the start of a text.
    """
    sizes = np.array([len(t) for t in texts], np.int64)
    joined = b"\n".join(texts).translate(LOWER) + b"\n"
    words = joined.split()
    keys = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words)) & ~_LOW
    raw = np.frombuffer(joined, np.uint8)
    space = _SPACE[raw]
    last = np.flatnonzero(~space[:-1] & space[1:])  # the last byte of each word
    ahead = np.maximum(last, 1) - 1
    before = np.where((last > 0) & ~space[ahead], raw[ahead], 0).astype(np.int64)
    classes = _CLASS[raw[last].astype(np.int64) * 256 + before]
    text = np.searchsorted(np.cumsum(sizes + 1), last, side="right")
    counts = np.bincount(text, minlength=len(texts)) + 1
    out = np.empty(len(words) + len(texts), np.uint64)
    context = np.zeros(len(out) + 1, np.uint8)
    place = np.arange(len(words)) + text
    ends = np.cumsum(counts) - 1
    out[place], out[ends] = keys, END
    context[place + 1] = classes
    context[ends + 1] = 0
    return out | context[:-1].astype(np.uint64), _before(out, counts), counts


def _before(words, counts):
    """The word before each token of texts with so many tokens."""
    before = np.empty(len(words), np.uint64)
    before[1:] = words[:-1]
    before[np.cumsum(counts) - counts] = START
    return before


def pair_hashes(keys, before):
    return finish(before * _STEP + (keys & ~_LOW))


# ------------------------------------------------------------------------------------ packing

def _pack(values):
    """Numbers compressed, all their first bytes before all second ones and so on; before them the
    number of bytes that whole numbers need."""
    values = np.ascontiguousarray(values)
    planes = values.reshape(-1, 1).view(np.uint8)
    width = planes.shape[1]
    if values.dtype.kind in "iu" and len(values):
        most = int(values.view(f"u{width}").max())
        width = max(1, (most.bit_length() + 7) // 8)
    return bytes([width]) + _ZIP.compress(np.ascontiguousarray(planes[:, :width].T))


def _unpack(blob, kind):
    planes = np.frombuffer(_UNZIP.decompress(memoryview(blob)[1:]), np.uint8).reshape(blob[0], -1)
    out = np.zeros((planes.shape[1], np.dtype(kind).itemsize), np.uint8)
    out[:, :len(planes)] = planes.T
    return out.reshape(-1).view(kind)


def _pack_sorted(keys):
    """Sorted keys, packed by their differences."""
    steps = keys.copy()
    steps[1:] -= keys[:-1]
    return _pack(steps)


def _unpack_sorted(blob):
    return np.cumsum(_unpack(blob, np.uint64), dtype=np.uint64)


def _cuts(hashes, pieces):
    """Where each piece of the range of hashes begins among sorted ones, and where the last ends."""
    ends = [(i << 64) // pieces for i in range(1, pieces)]
    return np.concatenate([[0], np.searchsorted(hashes, np.array(ends, np.uint64)),
                           [len(hashes)]]).astype(np.int64)


def _distinct(values):
    """Distinct values in order, and each value's place among them."""
    coded = pa.array(values.view(np.int64)).dictionary_encode()
    found = coded.dictionary.to_numpy().view(np.uint64)
    order = np.argsort(found)
    place = np.empty(len(found), np.uint32)
    place[order] = np.arange(len(found))
    return found[order], place[coded.indices.to_numpy()]


def _ranked(numbers, most):
    """As ``_distinct``, for numbers below ``most``; as a rule one sort of numbers and places."""
    bits = len(numbers).bit_length()
    if most << bits > 1 << 64:
        return _distinct(numbers)
    both = np.sort(numbers << np.uint64(bits) | np.arange(len(numbers), dtype=np.uint64))
    values = both >> np.uint64(bits)
    new = np.append(True, values[1:] != values[:-1])[:len(values)]
    place = np.empty(len(numbers), np.uint32)
    place[(both & np.uint64((1 << bits) - 1)).astype(np.int64)] = np.cumsum(new) - 1
    return values[new], place


def _add_up(hashes, *columns):
    """Distinct hashes in order and the sums of the columns."""
    order = np.argsort(hashes)
    hashes = hashes[order]
    first = np.flatnonzero(np.append(True, hashes[1:] != hashes[:-1])) if len(hashes) else order
    return (hashes[first], *[np.add.reduceat(c[order], first) if len(c) else c for c in columns])


def _held(parts):
    """Parts of hashes and columns, added up to as few as HELD allows."""
    held, size = [], 0
    for part in parts:
        held.append(part)
        size += len(part[0])
        if size > HELD:
            held = [_add_up(*map(np.concatenate, zip(*held)))]
            size = len(held[0][0])
            if size > HELD // 2:
                yield held.pop()
                size = 0
    if held:
        yield _add_up(*map(np.concatenate, zip(*held)))


# ------------------------------------------------------------------------------------- chunks

_CHUNKS = "chunk long, ids binary, sizes binary, words binary, classes binary, tokens binary"
_NULL, _TRAINED, _SCORED = 1, 2, 4


def _chunks(limit):
    """Texts of a task as chunks: documents, and the tokens as places among their distinct words."""
    def chunk(number, held):
        ids, marks, keys, counts = [i for h in held for i in h[0]], *map(
            np.concatenate, zip(*[h[1:] for h in held]))
        distinct, at = _distinct(keys & ~_LOW)
        # A word's class is that of any token after it; without one it is never asked for.
        classes = np.zeros(len(distinct), np.uint8)
        classes[at[:-1]] = (keys[1:] & _LOW).astype(np.uint8)
        marks = marks | np.array([_NULL * (i is None) for i in ids], np.uint8)
        listed = np.array([i or 0 for i in ids], np.int64)
        return pa.RecordBatch.from_arrays(
            [pa.array([number], pa.int64()), *[pa.array([b], pa.binary()) for b in (
                _pack(np.concatenate([listed.view(np.uint8), marks])), _pack(counts),
                _pack_sorted(distinct), _pack(classes), _pack(at))]],
            names=[c.split()[0] for c in _CHUNKS.split(", ")])

    def run(batches):
        number, held, size = TaskContext.get().partitionId() << 32, [], 0
        for batch in batches:
            marks, done = sum(
                np.where(batch.column(c).to_numpy(zero_copy_only=False).astype(bool), m, 0)
                for c, m in (("trained", _TRAINED), ("scored", _SCORED))).astype(np.uint8), 0
            for ids, texts in text_slices([batch]):
                keys, _, counts = tokens(texts)
                if held and size + len(keys) > limit:
                    yield chunk(number, held)
                    number, held, size = number + 1, [], 0
                held.append((ids, marks[done:done + len(ids)], keys, counts))
                done += len(ids)
                size += len(keys)
        if held:
            yield chunk(number, held)
    return run


class Chunk:
    """The documents, words and tokens of a chunk; START stands behind its words."""

    def __init__(self, batch, at):
        ids, sizes, words, classes, tokens = (
            batch.column(c)[at].as_py() for c in ("ids", "sizes", "words", "classes", "tokens"))
        self.counts = _unpack(sizes, np.int64)
        ids = _unpack(ids, np.uint8)
        size = len(self.counts)
        marks = ids[8 * size:]
        self.ids = pa.array(ids[:8 * size].view(np.int64), pa.int64(),
                            mask=(marks & _NULL).astype(bool))
        self.trained, self.scored = ((marks & m).astype(bool) for m in (_TRAINED, _SCORED))
        self.words = np.append(_unpack_sorted(words), START)
        self.places = _unpack(tokens, np.uint32)
        self.starts = np.cumsum(self.counts) - self.counts
        self.before = np.empty_like(self.places)
        self.before[1:] = self.places[:-1]
        self.before[self.starts] = len(self.words) - 1
        # No class stands before a text: the class of START is 0.
        self.classes = np.append(_unpack(classes, np.uint8), np.uint8(0))[self.before]

    def pairs(self, tokens=slice(None)):
        """Distinct pairs in the order of their hashes, as hashes, places of the word before and of
        the word; and each token's place among them.  ``tokens``: those whose pairs are wanted."""
        bits = len(self.words).bit_length()
        joint, place = _ranked(self.before[tokens].astype(np.uint64) << np.uint64(bits)
                               | self.places[tokens], 1 << 2 * bits)
        before = (joint >> np.uint64(bits)).astype(np.int64)
        word = (joint & np.uint64((1 << bits) - 1)).astype(np.int64)
        hashes = pair_hashes(self.words[word], self.words[before])
        order = np.argsort(hashes)
        rank = np.empty(len(order), np.uint32)
        rank[order] = np.arange(len(order))
        return hashes[order], before[order], word[order], rank[place]

    def tokens_of(self, first, last, pieces):
        """Places of the tokens whose pairs lie in pieces first to last - 1."""
        hashes = pair_hashes(self.words[self.places], self.words[self.before])
        inside = hashes >= np.uint64((first << 64) // pieces) if first < pieces else np.zeros(
            len(hashes), bool)
        if last < pieces:
            inside &= hashes < np.uint64((last << 64) // pieces)
        return np.flatnonzero(inside)


# ----------------------------------------------------------------------------------- counting

#: Pairs of a piece, or those of a chunk in it; or only where a chunk's pairs are: how often each of
#: them occurs (0, 1 or more), and the places of the latter among the piece's pairs of that kind.
_PAIRS = ("piece int, more boolean, chunk long, words binary, contexts binary, before binary, "
          "counts binary, tables binary, kinds binary, places binary")


def _batch(schema, rows):
    """Rows as lists of cells, or as dictionaries of some of them, as one batch."""
    names, kinds = zip(*[c.split() for c in schema.split(", ")])
    types = {"int": pa.int32(), "long": pa.int64(), "boolean": pa.bool_(), "binary": pa.binary()}
    rows = [[r.get(n) for n in names] if isinstance(r, dict) else r for r in rows]
    return pa.RecordBatch.from_arrays(
        [pa.array(c, types[k]) for c, k in zip(zip(*rows), kinds)], names=list(names))


def _pair_row(piece, keys, before, counts, tables, **cells):
    """Pairs of one piece; in order of their words they take less room."""
    order = np.argsort(keys)
    contexts, before = _distinct(before[order])
    return dict(piece=piece, words=_pack_sorted(keys[order]), contexts=_pack_sorted(contexts),
                before=_pack(before), counts=_pack(counts[order]), tables=_pack(tables[order]),
                **cells)


def _pairs_of(batch, at):
    """(keys, words before, counts, tables) of one row of pairs."""
    words, contexts, before, counts, tables = (batch.column(c)[at].as_py() for c in (
        "words", "contexts", "before", "counts", "tables"))
    return (_unpack_sorted(words), _unpack_sorted(contexts)[_unpack(before, np.uint32)],
            _unpack(counts, np.int64), _unpack(tables, np.int64))


def _count(pieces, part):
    """Pairs of words of chunks, by the pieces of a part, and how often the training texts have
    them."""
    first, last = (pieces * p // PARTS for p in (part, part + 1))

    def run(batches):
        for batch in batches:
            for at in range(batch.num_rows):
                chunk = Chunk(batch, at)
                number = batch.column("chunk")[at].as_py() if chunk.scored.any() else None
                tokens = chunk.tokens_of(first, last, pieces)
                hashes, before, word, place = chunk.pairs(tokens)
                classes = np.zeros(len(chunk.words), np.uint64)
                classes[chunk.before] = chunk.classes
                keys, before = chunk.words[word] | classes[before], chunk.words[before]
                counts = np.bincount(place[np.repeat(chunk.trained, chunk.counts)[tokens]],
                                     minlength=len(keys))
                cuts = _cuts(hashes, pieces)
                rows = []
                for piece in range(first, last):
                    own = slice(cuts[piece], cuts[piece + 1])
                    if own.start < own.stop:
                        rows.append(_pair_row(
                            piece, keys[own], before[own], counts[own],
                            np.ones(own.stop - own.start, np.int64), chunk=number))
                if rows:
                    yield _batch(_PAIRS, rows)
    return run


def _by(batches, column):
    """Rows of equal number in ``column``, which follow one another, as lists of (batch, row)."""
    held, now = [], None
    for batch in batches:
        for at, number in enumerate(batch.column(column).to_pylist()):
            if number != now:
                if held:
                    yield now, held
                held, now = [], number
            held.append((batch.slice(at, 1), 0))
    if held:
        yield now, held


def _merge_pairs(batches):
    """One row of the pairs of a piece that occur once, and one of the others, with a table each;
    and for each chunk a row that tells where its pairs are."""
    for piece, rows in _by(batches, "piece"):
        chunks = [r[0].column("chunk")[0].as_py() for r in rows]
        parts = [_pairs_of(*r)[:3] for r in rows]
        ends = np.cumsum([len(p[0]) for p in parts])
        keys, before, counts = map(np.concatenate, zip(*parts))
        hashes = pair_hashes(keys, before)
        order = np.argsort(hashes)
        ordered = hashes[order]
        new = np.append(True, ordered[1:] != ordered[:-1])
        first = np.flatnonzero(new)
        place = np.empty(len(order), np.int64)
        place[order] = np.cumsum(new) - 1
        keys, before, counts = keys[order[first]], before[order[first]], np.add.reduceat(
            counts[order], first)
        out = []
        for more in (False, True):
            own = counts > 1 if more else counts == 1
            if own.any():
                out.append(_pair_row(piece, keys[own], before[own], counts[own],
                                     np.ones(int(own.sum()), np.int64), more=more))
        kinds, among = np.minimum(counts, 2).astype(np.uint8), np.cumsum(counts > 1) - 1
        for chunk, part in zip(chunks, np.split(place, ends[:-1])):
            if chunk is not None:
                part = np.sort(part)
                out.append(dict(piece=piece, chunk=chunk, kinds=_pack(kinds[part]),
                                places=_pack(np.diff(among[part[kinds[part] > 1]], prepend=0))))
        yield _batch(_PAIRS, out)


def _pair_statistics(batches):
    """Pairs that occur once, and twice."""
    out = np.zeros(2, np.int64)
    for batch in batches:
        for at in range(batch.num_rows):
            counts = _pairs_of(batch, at)[2]
            out += [(counts == 1).sum(), (counts == 2).sum()]
    if out.any():
        yield array_rows(out, 1)


_ENTRIES = "piece int, keys binary, counts binary, customers binary"
#: Blocks keep the tables of their entries and words after each of the last SAMPLES sweeps.
_BLOCKS = _ENTRIES + ", tables binary, roots binary"


def _words_in(pairs):
    """Words and classes of batches of pairs, their tokens and tables."""
    for batch in pairs:
        for at in range(batch.num_rows):
            keys, _, counts, tables = _pairs_of(batch, at)
            first = np.flatnonzero(np.append(True, keys[1:] != keys[:-1]))
            yield keys[first], np.add.reduceat(counts, first), np.add.reduceat(tables, first)


def _word_rows(pieces):
    """Word and class, tokens, customers, by pieces: a table of a pair is a customer in the class."""
    def run(batches):
        for columns in _held(_words_in(batches)):
            cuts = _cuts(columns[0] & ~_LOW, pieces)
            yield _batch(_ENTRIES, [
                (piece, *_packed(*[c[cuts[piece]:cuts[piece + 1]] for c in columns]))
                for piece in np.flatnonzero(np.diff(cuts)).tolist()])
    return run


def _packed(keys, counts, customers):
    return _pack_sorted(keys), _pack(counts), _pack(customers)


def _blocks(batches):
    """The words of each piece as a block."""
    for piece, rows in _by(batches, "piece"):
        parts = [[batch.column(c)[at].as_py() for c in ("keys", "counts", "customers")]
                 for batch, at in rows]
        yield _batch(_BLOCKS, [(piece, *_packed(*_add_up(*map(np.concatenate, zip(*[
            (_unpack_sorted(k), _unpack(n, np.int64), _unpack(c, np.int64))
            for k, n, c in parts])))), None, None)])


class Words:
    """One block: entries (word, class, tokens, customers), where each word's entries begin, and the
    tables of both after the last sweeps."""

    def __init__(self, keys, tokens, customers, tables, roots):
        self.keys = _unpack_sorted(keys)
        self.tokens = _unpack(tokens, np.int64)
        self.counts = _unpack(customers, np.int64)
        self.classes = (self.keys & _LOW).astype(np.int64)
        word = self.keys & ~_LOW
        self.first = np.flatnonzero(np.append(True, word[1:] != word[:-1]))
        self.word = word[self.first]
        self.of = np.repeat(np.arange(len(self.first)), np.diff(np.append(self.first, len(word))))
        self.states = [] if tables is None else list(zip(
            _unpack(tables, np.int64).reshape(-1, len(self.keys)),
            _unpack(roots, np.int64).reshape(-1, len(self.word))))

    def state(self):
        """Tables of entries and words; before any sweep each has one."""
        return self.states[-1] if self.states else (
            np.ones(len(self.keys), np.int64), np.ones(len(self.word), np.int64))


def _words_of(batch):
    for row in zip(*[batch.column(c).to_pylist()
                     for c in ("keys", "counts", "customers", "tables", "roots")]):
        yield Words(*row)


def _statistics(batches):
    """Customers per class, then: words, tokens, entries of one customer and of two, words of one
    entry and of two."""
    out = np.zeros(CLASSES + 6, np.int64)
    for batch in batches:
        for w in _words_of(batch):
            out[:CLASSES] += np.bincount(w.classes, w.counts, CLASSES).astype(np.int64)
            entries = np.bincount(w.of)
            out[CLASSES:] += [
                len(w.word), w.tokens.sum(), (w.counts == 1).sum(), (w.counts == 2).sum(),
                (entries == 1).sum(), (entries == 2).sum()]
    if out.any():
        yield array_rows(out, 1)


# ------------------------------------------------------------------------------------ seating

def _seat(customers, base, others, discount, rng):
    """Tables after seating all customers of each dish one by one.

    ``base``: the dish's probability in the parent; ``others``: tables of other dishes.
    """
    tables = np.ones(len(customers), np.int64)
    active = np.flatnonzero(customers > 1)
    base, others, customers = base[active], others[active], customers[active]
    own = tables[active]
    seated = 1
    while len(active):
        group = 1 if seated < SINGLY else seated // 16
        new = (CONCENTRATION + discount * (others + own)) * base
        old = seated - discount * own
        own += _binomial(group, customers - seated, new / (new + old), rng)
        seated += group
        more = customers > seated
        if not more.all():
            tables[active[~more]] = own[~more]
            active, base, others, customers, own = (
                x[more] for x in (active, base, others, customers, own))
    return tables


def _binomial(group, left, chance, rng):
    """How many of a group's customers, or of those left, take a new table."""
    if group > 1 or not chance.all():
        return rng.binomial(np.minimum(group, left), chance)
    # A single one: what rng.binomial draws, by the same number, in a fraction of the time.
    drawn = rng.random(len(chance))
    return np.where(chance > 0.5, drawn <= chance, drawn > 1 - chance)


class Model:
    """Global numbers, and the totals of each sweep: tables per class, root customers and tables."""

    def __init__(self, statistics, pairs=(0, 0)):
        self.customers = statistics[:CLASSES].astype(float)
        self.words, self.tokens, one, two, single, double = map(int, statistics[CLASSES:])
        clip = lambda a, b: min(0.95, max(0.05, a / (a + 2 * b) if a + b else 0.5))
        self.discount, self.root_discount = clip(one, two), clip(single, double)
        self.pair_discount = clip(*map(int, pairs))
        self.uniform = 1 / (self.words + 1)
        self.totals = []

    def sweep(self, block):
        """Tables of a block's entries and words, seated anew."""
        tables, root = block.state()
        sweep, total = len(self.totals) - 1, self.totals[-1]
        rng = np.random.default_rng([sweep, int(block.word[0]), len(block.keys)])
        base = self.word_probability(np.add.reduceat(tables, block.first), root, total)
        others = np.maximum(total[:CLASSES][block.classes] - tables, 0)
        tables = _seat(block.counts, base[block.of], others, self.discount, rng)
        below = np.add.reduceat(tables, block.first)
        root = _seat(below, np.full(len(below), self.uniform),
                     np.maximum(total[-1] - root, 0), self.root_discount, rng)
        return tables, root

    def word_probability(self, customers, tables, total):
        """Of words in the root, given their customers and tables."""
        everyone = CONCENTRATION + total[-2]
        return ((customers - self.root_discount * tables)
                + (CONCENTRATION + self.root_discount * total[-1]) * self.uniform) / everyone

    def unknown(self, total):
        return (CONCENTRATION + self.root_discount * total[-1]) * self.uniform / (
            CONCENTRATION + total[-2])

    def in_class(self, classes, parents, own):
        """Of words in classes, given their probabilities in the parent by sample (columns of
        ``parents``) and what the class adds."""
        for s, total in enumerate(self.totals[-SAMPLES:]):
            own = own + self.backoff(total)[classes] * parents[:, s] / SAMPLES
        return own

    def after_word(self, kept, customers, tables, in_class):
        """Of words after a word, given what the pair keeps (its tokens less a discount for each
        table), the word's customers and tables, and the probability in its class."""
        return (kept + (CONCENTRATION + self.pair_discount * tables) * in_class) / (
            CONCENTRATION + customers)

    def backoff(self, total):
        """Share of the parent in each class."""
        return (CONCENTRATION + self.discount * total[:CLASSES]) / (CONCENTRATION + self.customers)


def _swept(model):
    """Blocks after one more sweep."""
    def run(batches):
        for batch in batches:
            for at, block in enumerate(_words_of(batch)):
                kept = [*block.states, model.value.sweep(block)][-SAMPLES:]
                yield _batch(_BLOCKS, [(
                    *[batch.column(c)[at].as_py() for c in ("piece", "keys", "counts", "customers")],
                    *[_pack(np.concatenate(c)) for c in zip(*kept)])])
    return run


def _totals(batches):
    """Tables per class, then customers and tables of the restaurant of single words."""
    out = np.zeros(CLASSES + 2, np.int64)
    for batch in batches:
        for block in _words_of(batch):
            tables, root = block.state()
            out[:CLASSES] += np.bincount(block.classes, tables, CLASSES).astype(np.int64)
            out[CLASSES:] += [tables.sum(), root.sum()]
    if out.any():
        yield array_rows(out, 1)


_SAMPLED = [f"p{s}" for s in range(SAMPLES)]
_PREDICTIVE = ("word long, n long, " + ", ".join(f"{p} double" for p in _SAMPLED)
               + ", classes array<int>, own array<double>")


def _predict(model):
    """Per word: its count, its probability in the parent by sample, and in each class where it
    has been seen what that restaurant adds, averaged over samples."""
    def run(batches):
        m = model.value
        for batch in batches:
            for block in _words_of(batch):
                parent, own = [], np.zeros(len(block.keys))
                for (tables, root), total in zip(block.states, m.totals[-SAMPLES:]):
                    parent.append(m.word_probability(np.add.reduceat(tables, block.first), root,
                                                     total))
                    own += (block.counts - m.discount * tables) / (
                        CONCENTRATION + m.customers[block.classes]) / SAMPLES
                offsets = pa.array(np.append(block.first, len(block.keys)).astype(np.int32))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(block.word.view(np.int64)),
                     pa.array(np.add.reduceat(block.tokens, block.first)), *map(pa.array, parent),
                     pa.ListArray.from_arrays(offsets, pa.array(block.classes.astype(np.int32))),
                     pa.ListArray.from_arrays(offsets, pa.array(own))],
                    names=["word", "n", *_SAMPLED, "classes", "own"])
    return run


# ------------------------------------------------------------------------------------ lookups

#: Lookups go by 56 bits of a word's hash, which take a byte less in shuffles.
_ASKED = ~np.uint64(255)
#: Values of words come without a chunk: tokens, by class what the class adds, and probabilities in
#: the root by sample; tables of words before without masks too.  Asked words come with masks of the
#: classes asked for; answers without words: tokens and tables, and by class the probability there.
_LOOKUP = "piece int, chunk long, words binary, masks binary, counts binary, chances binary"


def _lookup_row(piece, chunk=None, words=None, masks=None, counts=None, chances=None):
    return (piece, chunk, None if words is None else _pack_sorted(words),
            *[None if c is None else _pack(c) for c in (masks, counts, chances)])


def _lookup_batch(rows):
    return _batch(_LOOKUP, rows)


def _classes_of(masks):
    """For each class of each mask in order: the mask's place, and the class."""
    bits = np.unpackbits(masks.view(np.uint8), bitorder="little")
    return np.divmod(np.flatnonzero(bits), CLASSES)


def _place_in(masks, first, classes):
    """Places of classes in lists that have one entry for each class of each mask; ``first``: where
    a mask's entries begin."""
    below = (np.uint32(1) << classes.astype(np.uint32)) - np.uint32(1)
    return first + np.bitwise_count(masks & below)


def _starts(masks):
    sizes = np.bitwise_count(masks).astype(np.int64)
    return np.cumsum(sizes) - sizes


class Known:
    """The values of the words of a piece."""

    def __init__(self, words, tables):
        none = [(np.zeros(0, np.uint64), np.zeros(0, np.uint32), np.zeros(0, np.int64),
                 np.zeros((0, SAMPLES), np.float32), np.zeros(0, np.float32))]
        hashes, masks, n, parents, self.own = map(np.concatenate, zip(*(words or none)))
        order = np.argsort(hashes)
        self.words, self.masks, self.n, self.parents, self.first = (
            c[order] for c in (hashes, masks, n, parents, _starts(masks)))
        self.before, self.tables = _add_up(*map(np.concatenate, zip(*(
            tables or [(np.zeros(0, np.uint64), np.zeros(0, np.int64))]))))

    @staticmethod
    def _find(have, asked):
        at = np.minimum(np.searchsorted(have, asked), max(len(have) - 1, 0))
        return at, have[at] == asked if len(have) else np.zeros(len(asked), bool)

    def answer(self, words, masks, m, tokens):
        """Seating needs no ``tokens``; without them answers take less room."""
        counts = np.zeros((2, len(words)), np.int64)
        at, hit = self._find(self.before, words)
        counts[1, hit] = self.tables[at[hit]]
        at, hit = self._find(self.words, words)
        if tokens:
            counts[0, hit] = self.n[at[hit]]
        row, classes = _classes_of(masks)
        parents = np.tile([m.unknown(t) for t in m.totals[-SAMPLES:]], (len(row), 1))
        own = np.zeros(len(row))
        known = np.flatnonzero(hit[row])
        found = at[row[known]]
        parents[known] = self.parents[found]
        seen = (self.masks[found] >> classes[known].astype(np.uint32)) & np.uint32(1) > 0
        known, found = known[seen], found[seen]
        own[known] = self.own[_place_in(self.masks[found], self.first[found], classes[known])]
        return counts.reshape(-1), m.in_class(classes, parents, own).astype(np.float32)


def _answer(model, tokens):
    """Answers to the asked words of a piece, whose values come first; unknown words have no tokens
    and tables."""
    def run(batches):
        m = model.value
        now, words, tables, known = None, [], [], None
        for batch in batches:
            out = []
            for piece, chunk, keys, masks, counts, chances in zip(
                    *[c.to_pylist() for c in batch.columns]):
                if piece != now:
                    now, words, tables, known = piece, [], [], None
                keys = _unpack_sorted(keys)
                if chunk is None and masks is None:
                    tables.append((keys, _unpack(counts, np.int64)))
                elif chunk is None:
                    values, cut = _unpack(chances, np.float32), SAMPLES * len(keys)
                    words.append((keys, _unpack(masks, np.uint32), _unpack(counts, np.int64),
                                  values[:cut].reshape(-1, SAMPLES), values[cut:]))
                else:
                    if known is None:
                        known, words, tables = Known(words, tables), [], []
                    counts, chances = known.answer(keys, _unpack(masks, np.uint32), m, tokens)
                    out.append(_lookup_row(piece, chunk, counts=counts, chances=chances))
            if out:
                yield _lookup_batch(out)
    return run


def _answers(values, asked, pieces, model, tokens):
    rows = values.unionByName(asked).repartition(pieces, "piece").sortWithinPartitions(
        "piece", F.col("chunk").asc_nulls_first())
    return rows.mapInArrow(tidy(_answer(model, tokens)), _LOOKUP)


class Needs:
    """What tokens or pairs need, given distinct words and the places there and classes of each."""

    def __init__(self, words, places, classes):
        self.places, self.classes = places, classes
        bits = np.zeros(len(words) * CLASSES, np.uint8)
        bits[places.astype(np.int64) * CLASSES + classes] = 1
        self.masks = np.packbits(bits, bitorder="little").view(np.uint32)
        hashes = finish(words) & _ASKED
        self.order = np.argsort(hashes)
        self.hashes = hashes[self.order]

    def asked(self, chunk, pieces):
        cuts, masks = _cuts(self.hashes, pieces), self.masks[self.order]
        yield _lookup_batch([
            _lookup_row(piece, chunk, self.hashes[cuts[piece]:cuts[piece + 1]],
                        masks[cuts[piece]:cuts[piece + 1]])
            for piece in np.flatnonzero(np.diff(cuts)).tolist()])

    def read(self, rows):
        """(tokens of each word, tables of each word, probability of each token or pair in its
        class)"""
        counts, chances = [], []
        for batch, at in sorted(rows, key=lambda r: r[0].column("piece")[r[1]].as_py()):
            counts.append(_unpack(batch.column("counts")[at].as_py(), np.int64).reshape(2, -1))
            chances.append(_unpack(batch.column("chances")[at].as_py(), np.float32))
        numbers = np.empty((2, len(self.order)), np.int64)
        numbers[:, self.order] = np.concatenate(counts, axis=1)
        first = np.empty(len(self.order), np.int64)
        first[self.order] = _starts(self.masks[self.order])
        return (*numbers, np.concatenate(chances)[_place_in(
            self.masks[self.places], first[self.places], self.classes)].astype(float))


def _word_values(model, pieces):
    """Values of words; probabilities in single precision, which takes less room."""
    predict = _predict(model)

    def run(batches):
        for batch in predict(batches):
            hashes = finish(batch.column("word").to_numpy().view(np.uint64)) & _ASKED
            order = np.argsort(hashes)
            hashes, n = hashes[order], batch.column("n").to_numpy()[order]
            parents = np.column_stack([batch.column(c).to_numpy() for c in _SAMPLED])[order]
            lists = batch.column("classes")
            sizes = pa.compute.list_value_length(lists).to_numpy(zero_copy_only=False)
            bits = np.zeros(len(order) * CLASSES, np.uint8)
            bits[np.repeat(np.arange(len(order)), sizes) * CLASSES + lists.flatten().to_numpy()] = 1
            masks = np.packbits(bits, bitorder="little").view(np.uint32)
            first, masks = _starts(masks)[order], masks[order]
            ends = np.append(0, np.cumsum(sizes[order]))
            own = batch.column("own").flatten().to_numpy()[
                np.repeat(first - ends[:-1], sizes[order]) + np.arange(ends[-1])]
            cuts = _cuts(hashes, pieces)
            out = []
            for piece in np.flatnonzero(np.diff(cuts)).tolist():
                a, b = cuts[piece], cuts[piece + 1]
                out.append(_lookup_row(
                    piece, None, hashes[a:b], masks[a:b], n[a:b], np.concatenate(
                        [parents[a:b].reshape(-1), own[ends[a]:ends[b]]]).astype(np.float32)))
            yield _lookup_batch(out)
    return run


def _before_values(pieces):
    """Parts of the numbers of tables of words before."""
    def parts(batches):
        for batch in batches:
            for at in range(batch.num_rows):
                _, before, _, tables = _pairs_of(batch, at)
                yield _add_up(finish(before) & _ASKED, tables)

    def run(batches):
        for words, sums in _held(parts(batches)):
            cuts = _cuts(words, pieces)
            yield _lookup_batch([_lookup_row(
                piece, None, words[cuts[piece]:cuts[piece + 1]],
                counts=sums[cuts[piece]:cuts[piece + 1]])
                for piece in np.flatnonzero(np.diff(cuts)).tolist()])
    return run


# ----------------------------------------------------------------------------------- training

def _pair_needs(keys, before):
    """What pairs need, and the places of the words before."""
    words, places = _distinct(np.concatenate([keys & ~_LOW, before]))
    return (Needs(words, places[:len(keys)], (keys & _LOW).astype(np.int64)), places[len(keys):])


def _seat_pairs(model, number):
    """Pairs seated anew; each piece comes with the answers to what its pairs need."""
    def run(batches):
        m = model.value
        for piece, rows in _by(batches, "chunk"):
            own = [r for r in rows if r[0].column("words")[0].is_valid]
            keys, before, counts, tables = _pairs_of(*own[0])
            needs, before_at = _pair_needs(keys, before)
            _, everyone, base = needs.read([r for r in rows if not r[0].column("words")[0].is_valid])
            others = np.maximum(everyone[before_at] - tables, 0)
            rng = np.random.default_rng([number, piece, len(keys)])
            yield _batch(_PAIRS, [_pair_row(
                piece, keys, before, counts, _seat(counts, base, others, m.pair_discount, rng),
                more=True)])
    return run


def _pairs_ask(pieces):
    def run(batches):
        for batch in batches:
            for at in range(batch.num_rows):
                keys, before, _, _ = _pairs_of(batch, at)
                yield from _pair_needs(keys, before)[0].asked(
                    batch.column("piece")[at].as_py(), pieces)
    return run


def _seated(entries, statistics, sweeps, pieces):
    """(word table, Model): the restaurants of classes and words, given the customers of words that
    all pairs send."""
    spark = entries.sparkSession
    with small_batches(spark, 1000), shuffles_removed(spark):
        blocks = materialise(entries.repartition(pieces, "piece").sortWithinPartitions(
            "piece").mapInArrow(tidy(_blocks), _BLOCKS), "words")
    found = add_arrays(blocks.mapInArrow(_statistics, ARRAY_SCHEMA))
    model = Model(np.zeros(CLASSES + 6) if found is None else found, statistics)
    for sweep in range(sweeps + 1):
        if sweep:
            shared = spark.sparkContext.broadcast(model)
            with small_batches(spark, WIDE):
                swept = materialise(blocks.mapInArrow(tidy(_swept(shared)), _BLOCKS), "words")
            discard(blocks)
            blocks = swept
        total = add_arrays(blocks.mapInArrow(_totals, ARRAY_SCHEMA))
        model.totals.append((np.zeros(CLASSES + 2) if total is None else total).astype(float))
    return blocks, model


def _chunked(rows):
    """(chunks, pieces) of rows doc_id, text, trained, scored."""
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    return materialise(rows.mapInArrow(tidy(_chunks(CHUNK)), _CHUNKS), "chunks"), -(-size // PIECE) or 1


def _learn(chunks, pieces):
    """(pairs that occur once, other pairs, what the former add to the tables of words before, where
    the pairs of chunks are, word table, Model, written tables of the pairs)."""
    spark = chunks.sparkSession
    parts = []
    with small_batches(spark, 1000), shuffles_removed(spark):
        for part in range(PARTS):
            parts.append(materialise(chunks.mapInArrow(tidy(_count(pieces, part)), _PAIRS).repartition(
                pieces, "piece").sortWithinPartitions("piece").mapInArrow(tidy(_merge_pairs), _PAIRS),
                "pairs"))
    merged = functools.reduce(DataFrame.unionByName, parts)
    once, more = merged.where("not more"), merged.where("more")
    statistics = add_arrays(once.unionByName(more).mapInArrow(_pair_statistics, ARRAY_SCHEMA))
    statistics = (0, 0) if statistics is None else statistics
    words = -(-pieces // TO_WORDS)
    # What pairs that occur once add, and what the others ask for, is the same in every round.
    with small_batches(spark, 1000), shuffles_removed(spark):
        singles = materialise(once.mapInArrow(tidy(_word_rows(words)), _ENTRIES), "singles")
    with small_batches(spark, WIDE), shuffles_removed(spark):
        contexts, asked = (materialise(pairs.mapInArrow(tidy(rows), _LOOKUP), name) for pairs, rows, name
                           in ((once, _before_values(words), "contexts"),
                               (more, _pairs_ask(words), "asked")))

    def seated(sweeps):
        return _seated(singles.unionByName(more.mapInArrow(tidy(_word_rows(words)), _ENTRIES)),
                       statistics, sweeps, words)

    blocks, model = seated(SAMPLES)
    for number in range(ROUNDS):
        shared = spark.sparkContext.broadcast(model)
        values = blocks.mapInArrow(tidy(_word_values(shared, words)), _LOOKUP).unionByName(
            contexts).unionByName(more.mapInArrow(tidy(_before_values(words)), _LOOKUP))
        own = more.withColumn("chunk", F.col("piece").cast("long"))
        with small_batches(spark, WIDE), shuffles_removed(spark):
            both = own.unionByName(_answers(values, asked, words, shared, False),
                                   allowMissingColumns=True)
            # Fewer tasks than pieces: a piece takes less time than the start of a task.
            again = materialise(both.repartition(words, "chunk").sortWithinPartitions(
                "chunk").mapInArrow(tidy(_seat_pairs(shared, number)), _PAIRS), "seats")
        if number:
            discard(more)
        discard(blocks)
        more = again
        blocks, model = seated(SAMPLES if number + 1 < ROUNDS else SWEEPS)
    discard(singles, asked)
    return once, more, contexts, merged.where("kinds is not null"), blocks, model, parts


def _fit(texts):
    """(pairs that occur once, other pairs, word table, Model, pieces) from a column text."""
    chunks, pieces = _chunked(_marked(
        texts.select(F.lit(0).alias("doc_id"), "text"), F.lit(True), F.lit(False)))
    once, more, contexts, _, blocks, model, _ = _learn(chunks, pieces)
    discard(chunks, contexts)
    return once, more, blocks, model, pieces


def train(texts):
    """(word table, Model) from a table with a text column; a null text is empty."""
    chunks, pieces = _chunked(_marked(texts.select(F.lit(0).alias("doc_id"), "text"), F.lit(True),
                                      F.lit(False)))
    _, more, contexts, _, blocks, model, parts = _learn(chunks, pieces)
    discard(chunks, more, contexts, *parts)
    return blocks, model


# ------------------------------------------------------------------------------------ scoring

def _ask(pieces):
    def run(batches):
        for batch in batches:
            for at in range(batch.num_rows):
                chunk = Chunk(batch, at)
                if chunk.scored.any():
                    yield from Needs(chunk.words, chunk.places, chunk.classes).asked(
                        batch.column("chunk")[at].as_py(), pieces)
    return run


_FOUND = "chunk long, piece int, counts binary"


def _pairs_found(batches):
    """Tokens and tables of the pairs of chunks, by pieces; a piece's pairs come first."""
    now, counts, tables = None, None, None
    for batch in batches:
        out = []
        for at in range(batch.num_rows):
            piece, chunk = batch.column("piece")[at].as_py(), batch.column("chunk")[at].as_py()
            if piece != now:
                now, counts, tables = piece, np.zeros(0, np.int64), np.zeros(0, np.int64)
            if chunk is None:
                keys, before, counts, tables = _pairs_of(batch, at)
                order = np.argsort(pair_hashes(keys, before))
                counts, tables = counts[order], tables[order]
                continue
            kinds = _unpack(batch.column("kinds")[at].as_py(), np.uint8)
            places = np.cumsum(_unpack(batch.column("places")[at].as_py(), np.int64))
            found = np.stack([kinds, kinds]).astype(np.int64)
            found[:, kinds > 1] = counts[places], tables[places]
            out.append((chunk, piece, _pack(found.reshape(-1))))
        if out:
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*out), (pa.int64(), pa.int32(), pa.binary()))],
                names=[c.split()[0] for c in _FOUND.split(", ")])


_SCORES = "doc_id long, n_tokens long, n_known long, base_score double, score double"


def _score(model):
    """Scores of the texts of chunks that come with the answers to what their tokens need."""
    def run(batches):
        m = model.value
        add = np.log10(m.tokens + m.words + 1) if m.words else 0.0
        for _, rows in _by(batches, "chunk"):
            chunk = Chunk(*next(r for r in rows if r[0].column("ids")[0].is_valid))
            if not chunk.scored.any():
                continue
            rows = [r for r in rows if not r[0].column("ids")[0].is_valid]
            n, tables, in_class = Needs(chunk.words, chunk.places, chunk.classes).read(
                [r for r in rows if r[0].column("chances")[0].is_valid])
            found = sorted((r[0].column("piece")[0].as_py(), r[0].column("counts")[0].as_py())
                           for r in rows if not r[0].column("chances")[0].is_valid)
            seen, taken = np.concatenate(
                [_unpack(blob, np.int64).reshape(2, -1) for _, blob in found], axis=1)
            place = chunk.pairs()[3]
            # A word is followed as often as it occurs, and the start by each text, as its end.
            customers = n.copy()
            customers[-1] = n[np.searchsorted(chunk.words[:-1], END)]
            chance = m.after_word((seen - m.pair_discount * taken)[place], customers[chunk.before],
                                  tables[chunk.before], in_class)
            known = n[chunk.places]
            sums = [np.add.reduceat(v, chunk.starts) for v in (
                (known > 0).astype(np.int64), np.log10(known + 1) - add, np.log10(chance))]
            yield pa.RecordBatch.from_arrays(
                [chunk.ids, pa.array(chunk.counts), *map(pa.array, sums)],
                names=[c.split()[0] for c in _SCORES.split(", ")]).filter(pa.array(chunk.scored))
    return run


def _scores(rows):
    """Scores of the rows marked ``scored``, learnt from those marked ``trained``."""
    spark = rows.sparkSession
    chunks, pieces = _chunked(rows)
    _, more, single, places, blocks, model, parts = _learn(chunks, pieces)
    shared = spark.sparkContext.broadcast(model)
    word_pieces = -(-pieces // TO_WORDS)
    both = more.unionByName(places).repartition(pieces, "piece").sortWithinPartitions(
        "piece", F.col("chunk").asc_nulls_first())
    with small_batches(spark, WIDE), shuffles_removed(spark):
        first = materialise(both.mapInArrow(tidy(_pairs_found), _FOUND), "found")
        contexts = materialise(single.unionByName(more.mapInArrow(
            tidy(_before_values(word_pieces)), _LOOKUP)), "contexts")
    # Pairs take most room: they go before the lookup begins.
    discard(more, single, *parts)
    words = blocks.mapInArrow(tidy(_word_values(shared, word_pieces)), _LOOKUP)
    with small_batches(spark, WIDE), shuffles_removed(spark):
        second = materialise(_answers(words.unionByName(contexts), chunks.mapInArrow(
            tidy(_ask(word_pieces)), _LOOKUP), word_pieces, shared, True), "answers")
    discard(blocks, contexts)
    answers = first.unionByName(second.select("chunk", "piece", "counts", "chances"),
                                allowMissingColumns=True)
    both = chunks.unionByName(answers, allowMissingColumns=True)
    with small_batches(spark, WIDE), shuffles_removed(spark):
        scores = materialise(both.repartition(pieces, "chunk").sortWithinPartitions(
            "chunk").mapInArrow(tidy(_score(shared)), _SCORES), "scores")
    discard(chunks, first, second)
    return scores.select("doc_id", "n_tokens", "n_known",
                         F.lit(model.tokens).cast("long").alias("train_tokens"), "base_score",
                         "score")


def _marked(table, trained, scored):
    return table.select(F.col("doc_id").cast("long").alias("doc_id"), "text",
                        trained.alias("trained"), scored.alias("scored"))


def language_model_scores(documents, training):
    """One row per row of ``documents``: doc_id, n_tokens, n_known, train_tokens, base_score, score.

    ``training`` is a table with a text column.  Tokens are words between ASCII white space,
    lower-cased in A-Z, and one end; a null text is empty and has the end alone.  base_score adds
    log10((c + 1) / (N + V + 1)); score is the model's log10 probability of the text.  Without
    training texts both are 0.  Null ids and repeated rows are rows like others.
    """
    yes, no = F.lit(True), F.lit(False)
    return _scores(_marked(documents, no, yes).unionByName(
        _marked(training.select(F.lit(0).alias("doc_id"), "text"), yes, no)))


def held_out_scores(documents, folds=7, held=2):
    """The scores of all rows, learnt from rows whose crc32(doc_id) mod ``folds`` is not ``held``.

    A null doc_id counts as the empty text there.
    """
    bucket = crc_bucket(F.col("doc_id"), folds)
    scores = _scores(_marked(documents, bucket != held, F.lit(True)))
    return scores.select("doc_id", (bucket == held).alias("held_out"), "n_tokens", "n_known",
                         "train_tokens", "base_score", "score")
