"""Token ids in files compressed by a static range asymmetric numeral system (rANS).

One frequency table, counted over all ids, is shared by all files.  Ids are cut into blocks that
decode independently; inside a block, ids are dealt to interleaved lanes, each with a state of its
own, so that numpy advances all lanes of all blocks at once.

A file is a row of a Parquet table, so that Spark's committer drops what lost tasks have written and
any store will do: (part, seq, start, n_docs, n_ids, body).  ``start`` counts the part's ids before
it.  The body, little-endian throughout:

    magic "RNS1", crc32 of the frequency table u32, scale bits u32, lanes u32, ids per block u32,
    number of blocks u32, ids u64, documents u64, size of the document list u64
    document list: zlib of (id i64, 1 if the id is null u8, number of ids i64), column by column
    index: for each block its first word in the stream u64, crc32 of its ids u32, crc32 of its words
           u32, and the start state of each lane u64: the checkpoints from which it decodes
    stream: 32-bit words

The table lies beside the files as (id, frequency) rows; frequencies sum to 2 ** scale bits.
"""

import os
import struct
import zlib
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark import TaskContext
from pyspark.sql import functions as F

from ..sources.shared import discard, materialise
from .common import KEPT, add_arrays, array_rows, drop_kept, tidy

SCALE = 18
LANES = 16
BLOCK = 4096
#: A file is closed once it holds so many ids; a longer document still stays in one file.
FILE_IDS = 1 << 20
#: Words and stems whose ids a Python worker remembers.
REMEMBERED = 1_000_000
#: Bytes of words that it remembers; words of one slice are held together, however long.
REMEMBERED_BYTES = 1 << 25
END_ID = 1
MAGIC = b"RNS1"
_HEAD = struct.Struct("<4sIIIIIQQQ")
_LOW = np.uint64(1 << 31)
_W = np.uint64(32)
_S = np.uint64(SCALE)


# ------------------------------------------------------------------------------- text to ids

#: Words of Latin letters (below U+0100), and perhaps one sign after them.
_PLAIN = "^[A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff]+[.,]?$"
#: Python holds at most about this many bytes of text as separate words.
SLICE = 1 << 23
#: Byte-level tokenizers write a byte as the letter of its number, or from U+0100 on, in order, if
#: that is no visible sign.
_BYTE_LETTERS = {b: 256 + i for i, b in enumerate(
    b for b in range(256) if not (33 <= b <= 126 or 161 <= b <= 255 and b != 173))}
#: So many stems are encoded as one text.
TOGETHER = 4096


class Memory:
    """The ids of words, one after the other; the words are an Arrow array."""

    def __init__(self, kind):
        self.words, self.used = pa.array([], pa.large_string()), 0
        self.pool = np.empty(1 << 16, kind)
        self.first, self.length = np.zeros(1 << 16, np.int64), np.zeros(1 << 16, np.int32)

    def find(self, words):
        """Where each word stands; -1 if it is not known."""
        if not len(self.words):
            return np.full(len(words), -1)
        return pc.fill_null(pc.index_in(words, self.words), -1).to_numpy().astype(np.int64)

    def take(self, words, ids, lengths):
        """Remember words that are not known yet; ``ids`` are those of all, ``lengths`` how many."""
        at, count = len(self.words), len(words)
        while at + count > len(self.first):
            self.first, self.length = (np.concatenate([x, np.zeros_like(x)])
                                       for x in (self.first, self.length))
        if self.used + len(ids) > len(self.pool):
            self.pool = np.concatenate([self.pool[:self.used], np.empty(
                self.used + 2 * len(ids), self.pool.dtype)])
        self.pool[self.used:self.used + len(ids)] = ids
        self.length[at:at + count] = lengths
        self.first[at:at + count] = self.used + np.cumsum(lengths) - lengths
        self.used += len(ids)
        self.words = pa.concat_arrays([self.words, words])

    def ids(self, places):
        """The ids of the words at these places, and how many each has."""
        first, length = self.first[places], self.length[places].astype(np.int64)
        run = np.arange(int(length.sum())) - np.repeat(np.cumsum(length) - length, length)
        return self.pool[np.repeat(first, length) + run], length


class WordEncoder:
    """Encodes whole texts with a tokenizer that never joins across white space.

    Such a tokenizer gives a text the ids of its words one after the other, so of each slice of
    texts only the distinct words are encoded.  From words of letters a final sign is cut, the rest
    is lower-cased as the tokenizer does, and these stems are remembered, in two generations: what the
    young one lacks is moved from the old one, which is forgotten when the young one is full.  Many
    stems are encoded as one text; the ids that end a word tell where one stops.
    """

    def __init__(self, path):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        self.size = self.tokenizer.get_vocab_size(with_added_tokens=True)
        self.kind = np.uint16 if self.size <= 65536 else np.uint32
        suffix = getattr(self.tokenizer.model, "end_of_word_suffix", None)
        self.ends = np.zeros(self.size, bool)
        if suffix:
            for token, number in self.tokenizer.get_vocab().items():
                self.ends[number] = token.endswith(suffix)
        self.signs = [self._alone([sign])[0] for sign in ".,"]
        # Stems are only cut where the tokenizer does the same.
        probe = self._alone(["Straße.", "straße", "été,", "ÉTÉ"])
        self.stems = bool(suffix) and [len(x) for x in self.signs] == [1, 1] and [
            list(x) for x in probe] == [[*probe[1], *self.signs[0]], list(probe[1]),
                                        [*probe[3], *self.signs[1]], list(probe[3])]
        # The model alone cuts stems, in letters for their bytes, if that gives the same.
        sure = ["a", "straight", "qzxvkj", "internationalisation", "hello", "straße", "été", "ÿþæðø",
                "mañana", "\u00c3"]
        self.direct = self.stems and [self._direct(w.lower()) for w in sure] == [
            list(x) for x in self._alone(sure)]
        self.old, self.young = Memory(self.kind), Memory(self.kind)

    def _alone(self, texts):
        return [np.array(e.ids, np.uint32) for e in self.tokenizer.encode_batch_fast(
            texts, add_special_tokens=False)]

    def _direct(self, stem):
        if not stem.isascii():
            stem = stem.encode().decode("latin-1").translate(_BYTE_LETTERS)
        return [t.id for t in self.tokenizer.model.tokenize(stem)]

    def _stems(self, stems):
        """Ids of all stems, and the number of each."""
        if not self.direct:
            return self._together(stems)
        found = list(map(self._direct, stems))
        lengths = np.fromiter(map(len, found), np.int64, len(found))
        return np.fromiter(chain.from_iterable(found), np.uint32, int(lengths.sum())), lengths

    def _together(self, stems):
        """As ``_stems``, by the whole tokenizer, many stems as one text."""
        ids, lengths = [], []
        for at in range(0, len(stems), TOGETHER):
            part = stems[at:at + TOGETHER]
            own = self._alone([" ".join(part)])[0]
            stops = np.flatnonzero(self.ends[own]) + 1
            if len(stops) != len(part) or (len(own) and stops[-1] != len(own)):
                apart = self._alone(part)
                own, stops = np.concatenate(apart), np.cumsum([len(x) for x in apart])
            ids.append(own)
            lengths.append(np.diff(stops, prepend=0))
        return np.concatenate(ids), np.concatenate(lengths)

    def _places(self, words, encode):
        """Where each of the distinct words (an Arrow array) is remembered, among the young."""
        young, words = self.young, words.cast(pa.large_string())
        if (len(young.words) + len(words) > REMEMBERED // 2
                or young.words.nbytes + words.nbytes > REMEMBERED_BYTES // 2):
            self.old, self.young = young, Memory(self.kind)
        at = self.young.find(words)
        lacking = np.flatnonzero(at < 0)
        if len(lacking):
            known, missing = len(self.young.words), words.take(pa.array(lacking))
            before = self.old.find(missing)
            moved, new = np.flatnonzero(before >= 0), np.flatnonzero(before < 0)
            at[lacking[np.concatenate([moved, new])]] = np.arange(known, known + len(lacking))
            if len(moved):
                self.young.take(missing.take(pa.array(moved)), *self.old.ids(before[moved]))
            if len(new):
                missing = missing.take(pa.array(new))
                self.young.take(missing, *encode(missing.to_pylist()))
        return at

    def _apart(self, words):
        found = self._alone(words)
        return (np.concatenate(found) if found else np.zeros(0, np.uint32),
                np.array([len(x) for x in found], np.int64))

    def encode(self, texts):
        """The ids of all texts (an Arrow array without nulls) in one array, and each's number."""
        lists = pc.ascii_split_whitespace(texts)
        flat = lists.flatten().dictionary_encode()
        words, word = flat.dictionary, flat.indices.to_numpy()
        plain = pc.match_substring_regex(words, _PLAIN) if self.stems else pa.array(
            np.zeros(len(words), bool))
        is_plain = plain.to_numpy(zero_copy_only=False)
        # The ids of the distinct words, one after the other.
        odd = words.filter(pc.invert(plain))
        stem = words.filter(plain)
        sign = np.where(pc.ends_with(stem, ".").to_numpy(zero_copy_only=False), 0, np.where(
            pc.ends_with(stem, ",").to_numpy(zero_copy_only=False), 1, -1))
        stem = pc.utf8_lower(pc.utf8_rtrim(stem, ".,")).dictionary_encode()
        parts = []
        for names, encode, where in ((odd, self._apart, None), (
                stem.dictionary, self._stems, stem.indices.to_numpy())):
            at = self._places(names, encode)
            length, first = self.young.length[at].astype(np.int64), self.young.first[at]
            if where is not None:
                length, first = length[where], first[where]
            parts.append((self.young.pool, first, length))
        sizes = np.zeros(len(words), np.int64)
        sizes[~is_plain], sizes[is_plain] = parts[0][2], parts[1][2] + (sign >= 0)
        begin = np.cumsum(sizes) - sizes
        ids = np.zeros(int(sizes.sum()), self.kind)
        for (pool, first, length), here in zip(parts, (begin[~is_plain], begin[is_plain])):
            run = np.arange(int(length.sum())) - np.repeat(np.cumsum(length) - length, length)
            ids[np.repeat(here, length) + run] = pool[np.repeat(first, length) + run]
        signed = np.flatnonzero(sign >= 0)
        ids[begin[is_plain][signed] + parts[1][2][signed]] = np.array(
            [x[0] if len(x) else 0 for x in self.signs], self.kind)[sign[signed]]
        # The ids of all words in order.
        length = sizes[word]
        before = np.cumsum(length) - length
        run = np.repeat(begin[word] - before, length)
        run += np.arange(len(run))
        ends = np.concatenate([[0], np.cumsum(length)])[np.asarray(lists.offsets)]
        return ids[run], np.diff(ends)


_ENCODERS = KEPT.setdefault("encoders", {})


def encoder(path):
    if path not in _ENCODERS:
        _ENCODERS[path] = WordEncoder(path)
    return _ENCODERS[path]


_ENCODED = "doc_id long, ids binary, chunk int, part int, data binary"


def _encode_texts(path, end_id):
    """Each text's ids, and after a task's last text how often each id was used, as rows with a chunk."""
    def run(batches):
        coder, pack = encoder(path), zstandard.ZstdCompressor(level=1)
        used = np.zeros(coder.size, np.int64)
        for batch in batches:
            texts = pc.fill_null(batch.column("text"), "")
            size = np.concatenate([[0], np.cumsum(pc.binary_length(texts).to_numpy().astype(
                np.int64))])
            at = 0
            while at < len(texts):
                stop = max(at + 1, int(np.searchsorted(size, size[at] + SLICE, "right")) - 1)
                flat, counts = coder.encode(texts.slice(at, stop - at))
                ends = np.cumsum(counts)
                own = np.insert(flat, ends, end_id)  # each text's ids and the end
                stops = ends + np.arange(1, len(ends) + 1)
                blobs = [pack.compress(own[a:b].tobytes())
                         for a, b in zip(np.concatenate([[0], stops[:-1]]).tolist(),
                                         stops.tolist())]
                used += np.bincount(own, minlength=coder.size)
                none = pa.nulls(stop - at, pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(at, stop - at), pa.array(blobs, pa.binary()),
                     none, none, pa.nulls(stop - at, pa.binary())], names=names)
                at = stop
        if used.any():
            counts = array_rows(used, 8)
            yield pa.RecordBatch.from_arrays(
                [pa.nulls(8, pa.int64()), pa.nulls(8, pa.binary()), *counts.columns], names=names)

    names = [c.split()[0] for c in _ENCODED.split(", ")]
    return run


# ------------------------------------------------------------------------------- ids to bytes

def frequencies(counts):
    """Counts scaled to a sum of 2 ** SCALE; every id that occurs keeps at least 1."""
    total = int(counts.sum())
    if not total:
        counts = np.ones_like(counts)
        total = len(counts)
    if (counts > 0).sum() > 1 << SCALE:
        raise ValueError("more ids than the scale has room for")
    freq = np.where(counts > 0, np.maximum(1, (counts.astype(float) * (1 << SCALE) / total).astype(
        np.int64)), 0)
    over = int(freq.sum()) - (1 << SCALE)
    for k in np.argsort(-freq, kind="stable"):
        if over <= 0:
            break
        less = min(over, int(freq[k]) // 2)
        freq[k] -= less
        over -= less
    freq[int(np.argmax(freq))] -= over
    return freq


class Table:
    def __init__(self, freq):
        self.freq = np.asarray(freq).astype(np.uint64)
        self.start = (np.cumsum(self.freq) - self.freq).astype(np.uint64)
        self.symbol = np.repeat(np.arange(len(freq)), np.asarray(freq)).astype(np.uint32)
        self.crc = zlib.crc32(self.freq.astype("<u4").tobytes())
        self.fill = int(np.argmax(self.freq))


def encode_file(ids, doc_ids, lengths, table):
    """One file from the ids of its documents."""
    ids = np.asarray(ids)
    n, blocks = len(ids), -(-len(ids) // BLOCK)
    steps = BLOCK // LANES
    if n and not table.freq[ids].all():
        raise ValueError("an id that the table does not hold")
    padded = np.full(blocks * BLOCK, table.fill, np.int64)
    padded[:n] = ids
    grid = padded.reshape(blocks, steps, LANES)
    state = np.full((blocks, LANES), _LOW)
    words = np.zeros((blocks, steps, LANES), np.uint32)
    sent = np.zeros((blocks, steps, LANES), bool)
    for t in range(steps - 1, -1, -1):
        freq, start = table.freq[grid[:, t]], table.start[grid[:, t]]
        over = state >= freq << np.uint64(63 - SCALE)
        words[:, t], sent[:, t] = state, over  # the cast keeps the low 32 bits
        state = np.where(over, state >> _W, state)
        quotient = state // freq
        state = (quotient << _S) + (state - quotient * freq) + start
    stream = words[sent]
    sizes = sent.reshape(blocks, -1).sum(1)
    firsts = np.cumsum(sizes) - sizes
    index = np.zeros(blocks, _index_type())
    index["first"], index["state"] = firsts, state
    ids4 = ids.astype("<u4")
    for b in range(blocks):
        index["ids_crc"][b] = zlib.crc32(ids4[b * BLOCK:(b + 1) * BLOCK].tobytes())
        index["words_crc"][b] = zlib.crc32(stream[firsts[b]:firsts[b] + sizes[b]].tobytes())
    null = np.array([d is None for d in doc_ids], np.uint8)
    listed = zlib.compress(np.array([d or 0 for d in doc_ids], "<i8").tobytes() + null.tobytes()
                           + np.asarray(lengths, "<i8").tobytes(), 1)
    return b"".join([_HEAD.pack(MAGIC, table.crc, SCALE, LANES, BLOCK, blocks, n, len(doc_ids),
                                len(listed)), listed, index.tobytes(), stream.tobytes()])


def _index_type():
    return np.dtype([("first", "<u8"), ("ids_crc", "<u4"), ("words_crc", "<u4"),
                     ("state", "<u8", (LANES,))])


def read_index(body, table):
    """(document ids, their numbers of ids, number of ids, block index, stream) of a file."""
    magic, crc, scale, lanes, block, blocks, n, docs, size = _HEAD.unpack_from(body)
    if magic != MAGIC or (scale, lanes, block) != (SCALE, LANES, BLOCK):
        raise ValueError("not a token file of this format")
    if crc != table.crc:
        raise ValueError("the file was written with another frequency table")
    at = _HEAD.size
    listed = zlib.decompress(body[at:at + size])
    ids = np.frombuffer(listed, "<i8", docs).tolist()
    null = np.frombuffer(listed, np.uint8, docs, 8 * docs)
    lengths = np.frombuffer(listed, "<i8", docs, 9 * docs)
    at += size
    index = np.frombuffer(body, _index_type(), blocks, at)
    stream = np.frombuffer(body, "<u4", -1, at + index.nbytes)
    return [None if x else i for i, x in zip(ids, null)], lengths, n, index, stream


def decode_blocks(index, stream, n, table, first=0, last=None):
    """The ids of blocks first to last - 1; any range decodes from its own checkpoints."""
    last = len(index) if last is None else last
    ends = np.append(index["first"][1:], len(stream)).astype(np.int64)
    at = index["first"][first:last].astype(np.int64)
    for b in range(first, last):
        if zlib.crc32(stream[int(index["first"][b]):ends[b]].tobytes()) != index["words_crc"][b]:
            raise ValueError(f"block {b}: damaged")
    steps = BLOCK // LANES
    state = index["state"][first:last].astype(np.uint64)
    out = np.empty((last - first, steps, LANES), np.uint32)
    mask = np.uint64((1 << SCALE) - 1)
    padded = np.append(stream, np.zeros(LANES, np.uint32))
    for t in range(steps):
        slot = state & mask
        symbol = table.symbol[slot.astype(np.int64)]
        out[:, t] = symbol
        state = table.freq[symbol] * (state >> _S) + slot - table.start[symbol]
        low = state < _LOW
        place = at[:, None] + np.cumsum(low, 1) - low
        state = np.where(low, (state << _W) | padded[np.minimum(place, len(stream))], state)
        at = at + low.sum(1)
    ids = out.reshape(-1)[:max(0, min(n, last * BLOCK) - first * BLOCK)]
    for b in range(first, last):
        own = ids[(b - first) * BLOCK:(b - first + 1) * BLOCK]
        if zlib.crc32(own.astype("<u4").tobytes()) != index["ids_crc"][b]:
            raise ValueError(f"block {b}: wrong ids")
    return ids


# --------------------------------------------------------------------------------- the operator

_FILES = "part int, seq int, start long, n_docs long, n_ids long, body binary"


def _without_encoders(run):
    """``run`` for mapInArrow in workers that still remember the words of an earlier stage: once all
    texts are encoded, that is forgotten."""
    def forgotten(batches):
        drop_kept()
        yield from run(batches)
    return forgotten


def _write_files(table, kind):
    def run(batches):
        unpack, part, seq, start = (zstandard.ZstdDecompressor(), TaskContext.get().partitionId(),
                                    0, 0)
        docs, ids, held = [], [], 0

        def close():
            nonlocal docs, ids, held, seq, start
            body = encode_file(np.concatenate(ids), docs, [len(i) for i in ids], table.value)
            row = pa.RecordBatch.from_arrays(
                [pa.array([part], pa.int32()), pa.array([seq], pa.int32()), pa.array([start]),
                 pa.array([len(docs)]), pa.array([held]), pa.array([body], pa.binary())],
                names=["part", "seq", "start", "n_docs", "n_ids", "body"])
            seq, start = seq + 1, start + held
            docs, ids, held = [], [], 0
            return row

        for batch in batches:
            for doc_id, blob in zip(batch.column("doc_id").to_pylist(),
                                    batch.column("ids").to_pylist()):
                own = np.frombuffer(unpack.decompress(blob), kind)
                docs.append(doc_id)
                ids.append(own)
                held += len(own)
                if held >= FILE_IDS:
                    yield close()
        if docs:
            yield close()
    return run


def _read_files(table):
    def run(batches):
        for batch in batches:
            for part, start, body in zip(*(batch.column(c).to_pylist()
                                           for c in ("part", "start", "body"))):
                docs, lengths, n, index, stream = read_index(body, table.value)
                ids = decode_blocks(index, stream, n, table.value).astype("<u4")
                ends = np.cumsum(lengths)
                firsts = ends - lengths
                yield pa.RecordBatch.from_arrays(
                    [pa.array(docs, pa.int64()), pa.array([part] * len(docs), pa.int32()),
                     pa.array(firsts + start), pa.array(lengths.astype(np.int64)),
                     pa.array([zlib.crc32(ids[a:b].tobytes()) for a, b in zip(firsts, ends)],
                              pa.int64())],
                    names=["doc_id", "part", "start", "n_tokens", "ids_crc32"])
    return run


def write_token_files(documents, path, end_id=END_ID):
    """Encode and write all documents in order of doc_id; returns (files, table of frequencies).

    ``documents`` needs doc_id and text; a null text is empty and gives the end id alone; null ids
    come first; rows of one id are ordered by a hash of their ids.
    """
    spark = documents.sparkSession
    docs = documents.select(F.col("doc_id").cast("long").alias("doc_id"),
                            F.col("text").cast("string").alias("text"))
    size = WordEncoder(path).size
    kind = np.uint16 if size <= 65536 else np.uint32
    encoded = materialise(docs.mapInArrow(
        tidy(_encode_texts(path, end_id), "encoders"), _ENCODED), "ids")
    ids = encoded.where("chunk is null").select("doc_id", "ids")
    counts = add_arrays(encoded.where("chunk is not null").select("chunk", "part", "data"))
    freq = frequencies(np.zeros(size, np.int64) if counts is None else counts)
    table = spark.sparkContext.broadcast(Table(freq))
    held = materialise(spark.createDataFrame(
        [(int(i), int(freq[i])) for i in np.flatnonzero(freq)], "id int, frequency int"),
        "frequencies")
    # A hash parts rows that share an id, or have none.
    order = ["doc_id", "mark", "ids"]
    ordered = ids.withColumn("mark", F.xxhash64("ids")).repartitionByRange(
        *order[:2]).sortWithinPartitions(*order)
    files = materialise(ordered.mapInArrow(tidy(
        _without_encoders(_write_files(table, kind))), _FILES), "files")
    discard(encoded)
    return files, held, size


def read_token_files(files, held, size):
    """One row per document, decoded from the files: doc_id, start, n_tokens, ids_crc32."""
    spark = files.sparkSession
    freq = np.zeros(size, np.int64)
    for row in held.collect():  # at most the vocabulary
        freq[row["id"]] = row["frequency"]
    table = spark.sparkContext.broadcast(Table(freq))
    docs = files.mapInArrow(tidy(_without_encoders(_read_files(table))),
                            "doc_id long, part int, start long, n_tokens long, ids_crc32 long")
    before, offsets = 0, []
    for row in files.groupBy("part").agg(F.sum("n_ids").alias("n")).orderBy("part").collect():
        offsets.append((row["part"], before))  # one row per partition
        before += row["n"]
    parts = spark.createDataFrame(offsets, "part int, before long")
    return docs.join(F.broadcast(parts), "part").select(
        "doc_id", (F.col("start") + F.col("before")).alias("start"), "n_tokens", "ids_crc32")


def token_digests(documents, path, end_id=END_ID):
    return read_token_files(*write_token_files(documents, path, end_id))
