"""Spelling variants: pairs of words one edit apart, by composing finite-state machines.

The vocabulary is an acceptor A of words; E is the transducer that copies letters and inserts, deletes
or replaces exactly one.  The pairs wanted are the paths of A o E o A.  A state of the composition is
a triple (p, edits, q).  Before the edit both sides have read the same letters, so p = q; after it
both must read the same rest, so what follows is the meet of two right languages.

Spark unfolds the first letters of the composition.  Triples before the edit, one for each prefix of
words, are the initial states by which the work is dealt to tasks.  Triples after an edit within
that prefix are joined there and then: both sides have the same prefix and the same rest, so the word
with a mark in place of the edited letter (or before the next one) is the key, and a key holds at
most one word per letter and one without.  A prefix with more words than a task should hold is
unfolded further in the same way, until none is left; words are distinct, so this ends.

Within a task, the words of one initial state are built into a minimal acyclic acceptor, and the
composition is walked depth first; a memo of pairs of states whose right languages do not meet keeps
the walk from dead ends.
"""

import re
import zlib
from collections import Counter

import pyarrow as pa
from pyspark.sql import functions as F

from ..sources.shared import discard, materialise
from .common import LOWER, small_batches, text_slices

#: Letters before the first initial states, and the words of one state that a task holds.
INITIAL, STATE_WORDS = 3, 20_000
#: Words that a task holds while it counts, and bytes of text whose words it holds at once.
COUNTED, PIECE = 200_000, 1 << 22

# Bytes of UTF-8: the letters U+00C0 to U+00FF are C3 followed by 80 to BF.
_MAYBE = re.compile(rb"[a-z\xc3\x80-\xbf]+")
_LETTERS = re.compile(rb"(?:[a-z]|\xc3[\x80-\xbf])+")
_OTHER = re.compile(rb"[^a-z\xc3\x80-\xbf]")


# ------------------------------------------------------------------------------ the vocabulary

def _pieces(text):
    """The text cut between words into pieces of about PIECE bytes."""
    start = 0
    while start < len(text):
        cut = _OTHER.search(text, min(start + PIECE, len(text)))
        end = cut.start() if cut else len(text)
        yield text[start:end]
        start = end


def letter_runs(text, shortest):
    """Maximal runs of at least ``shortest`` letters in lower-cased UTF-8 bytes, as str."""
    long = re.compile(rb"[a-z\xc3\x80-\xbf]{%d,}" % shortest) if shortest > 1 else _MAYBE
    for piece in _pieces(text):
        for run in long.findall(piece):
            if run.isascii():
                yield run.decode()
            else:
                for own in _LETTERS.findall(run):
                    own = own.decode()
                    if len(own) >= shortest:
                        yield own


def _count_words(shortest, noise):
    def rows(held):
        return pa.RecordBatch.from_arrays([pa.array(list(held), pa.string()),
                                           pa.array(list(held.values()), pa.int64())],
                                          names=["word", "n"])

    def run(batches):
        held = Counter()
        for ids, texts in text_slices(batches):
            for doc_id, text in zip(ids, texts):
                own = Counter(letter_runs(text.translate(LOWER), shortest))
                if not noise:
                    held.update(own)
                    continue
                begin = zlib.crc32(f"{'' if doc_id is None else doc_id}:".encode())
                for word, n in own.items():
                    h = zlib.crc32(word.encode(), begin)
                    if h % noise == 0:
                        at = h % len(word)
                        word = word[:at] + word[at + 1:]
                        if len(word) < shortest:
                            continue
                    held[word] += n
                if len(held) > COUNTED:
                    yield rows(held)
                    held = Counter()
            if len(held) > COUNTED:
                yield rows(held)
                held = Counter()
        if held:
            yield rows(held)
    return run


def vocabulary(documents, min_letters=7, min_count=2, noise=None):
    """(word, n): maximal runs of ASCII letters and U+00C0 to U+00FF, lower-cased in A-Z only.

    Words have at least ``min_letters`` code points and ``min_count`` occurrences in all texts.  With
    ``noise``, a run loses one letter where crc32 of "<doc_id>:<run>" is divisible by it: the letter at
    the hash modulo the run's length.  Null texts have no words; a null doc_id counts as ''.
    """
    docs = documents.select("doc_id", F.col("text").cast("string").alias("text"))
    with small_batches(documents.sparkSession, 1000):
        return materialise(docs.mapInArrow(
            _count_words(min_letters, noise), "word string, n long").groupBy("word").agg(
            F.sum("n").alias("n")).where(F.col("n") >= min_count), "vocabulary")


# --------------------------------------------------------------------- machines within a task

class Acceptor:
    """The minimal acyclic acceptor of sorted distinct words; state 0 is where it starts."""

    def __init__(self, words):
        self.arcs, self.final = [{}], [False]
        self._known, self._meet = {}, {}
        path, last = [0], ""
        for word in words:
            same = 0
            for a, b in zip(word, last):
                if a != b:
                    break
                same += 1
            self._settle(path, last, same)
            for letter in word[same:]:
                self.arcs.append({})
                self.final.append(False)
                self.arcs[path[-1]][letter] = len(self.arcs) - 1
                path.append(len(self.arcs) - 1)
            self.final[path[-1]] = True
            last = word
        self._settle(path, last, 0)

    def _settle(self, path, word, keep):
        """Replace states below the first ``keep`` letters by equal ones that are known."""
        while len(path) - 1 > keep:
            state = path.pop()
            form = (self.final[state], tuple(self.arcs[state].items()))
            self.arcs[path[-1]][word[len(path) - 1]] = self._known.setdefault(form, state)

    def meet(self, p, q):
        """Do the right languages of two states share a word?"""
        known, stack = self._meet, [(p, q)]
        while stack:
            a, b = pair = stack[-1]
            if a == b or (self.final[a] and self.final[b]):
                known[pair] = True
            if pair in known:
                stack.pop()
                continue
            open_ = None
            for letter, x in self.arcs[a].items():
                y = self.arcs[b].get(letter)
                if y is None:
                    continue
                found = True if x == y else known.get((x, y))
                if found:
                    known[pair] = True
                    break
                if found is None:
                    open_ = (x, y)
            if pair in known:
                stack.pop()
            elif open_:
                stack.append(open_)
            else:
                known[pair] = False
                stack.pop()
        return known[p, q]

    def common(self, p, q, barred=None):
        """The words, in pieces, that both right languages hold; none begins with ``barred``."""
        if not self.meet(p, q):
            return
        path, stack = [], [(p, q, 0, "")]
        while stack:
            a, b, depth, letter = stack.pop()
            del path[depth:]
            path.append(letter)
            if self.final[a] and self.final[b]:
                yield "".join(path)
            for c, x in self.arcs[a].items():
                y = self.arcs[b].get(c)
                if y is not None and (depth or c != barred) and self.meet(x, y):
                    stack.append((x, y, depth + 1, c))

    def pairs(self):
        """All (u, v) accepted by the composition with the one-edit transducer, each pair once."""
        path, stack = [], [(0, 0, "")]
        while stack:
            state, depth, letter = stack.pop()  # the triple (state, no edit, state)
            del path[depth:]
            path.append(letter)
            arcs, prefix = list(self.arcs[state].items()), None
            for i, (c, p) in enumerate(arcs):
                stack.append((p, depth + 1, c))
                for d, q in arcs[i + 1:]:  # c becomes d
                    if self.meet(p, q):
                        prefix = prefix or "".join(path)
                        for rest in self.common(p, q):
                            yield prefix + c + rest, prefix + d + rest
                # c goes; the first letter that differs is meant, so the rest begins with another
                if len(arcs) > 1 or self.final[state]:
                    for rest in self.common(p, state, barred=c):
                        prefix = prefix or "".join(path)
                        yield prefix + c + rest, prefix + rest


_PAIRS = "word string, other string, other_n long"


def _compose(batches):
    """Near pairs, both ways, of each initial state's words; rows come sorted by state and word."""
    out, size = [], 0

    def flush():
        word, other, n = zip(*out)
        out.clear()
        return pa.RecordBatch.from_arrays([pa.array(word, pa.string()), pa.array(other, pa.string()),
                                           pa.array(n, pa.int64())],
                                          names=["word", "other", "other_n"])

    def states():
        now, words = None, {}
        for batch in batches:
            for state, word, n in zip(*(batch.column(c).to_pylist()
                                        for c in ("state", "word", "n"))):
                if state != now and words:
                    yield words
                    words = {}
                now = state
                words[word] = n
        if words:
            yield words

    for words in states():
        if len(words) < 2:
            continue
        for u, v in Acceptor(words).pairs():
            out += ((u, v, words[v]), (v, u, words[u]))
            size += len(u) + len(v)
            if len(out) > 20_000 or size > 1 << 22:
                yield flush()
                size = 0
    if out:
        yield flush()


# -------------------------------------------------------------------------------- the operator

def _early_pairs(words, first, last):
    """Pairs whose first differing letter stands at ``first`` to ``last`` - 1, both ways."""
    marked = words.select("n", F.explode(F.expr(
        f"flatten(transform(sequence({first}, {last} - 1), k -> filter(array("
        "named_struct('key', concat(left(word, k), '\\0', substr(word, k + 2)), "
        "'letter', substr(word, k + 1, 1), 'ok', length(word) > k), "
        "named_struct('key', concat(left(word, k), '\\0', substr(word, k + 1)), "
        "'letter', '', 'ok', length(word) >= k)), x -> x.ok)))")).alias("e")).select(
        "n", "e.key", "e.letter")
    # The mark, code point 0, is in no word.  At most one row per letter and one without: the key and
    # the letter are the word.
    groups = marked.groupBy("key").agg(F.collect_list(F.struct("letter", "n")).alias("w")).where(
        "size(w) > 1")
    pairs = groups.select("key", F.explode("w").alias("x"), "w").select(
        "key", "x", F.explode("w").alias("y")).where("x.letter != y.letter")
    # A letter that goes must differ from the next, else the first difference stands further right.
    after = "substr(key, instr(key, '\\0') + 1, 1)"
    return pairs.where(f"(x.letter != '' and y.letter != '') or x.letter || y.letter != {after}"
                       ).selectExpr("replace(key, '\\0', x.letter) word",
                                    "replace(key, '\\0', y.letter) other", "y.n other_n")


def near_pairs(words):
    """(word, other, other_n), both ways, for all words of (word, n) exactly one edit apart.

    Words are distinct and neither null nor empty; one edit is one code point inserted, deleted or
    replaced.
    """
    parts = [_early_pairs(words, 0, INITIAL)]
    open_, depth, step = words, INITIAL, 1
    closed = []
    while True:
        state = F.expr(f"left(word, {depth})")
        placed = open_.withColumn("state", state)
        large = materialise(placed.groupBy("state").count().where(
            F.col("count") > STATE_WORDS).select("state"), "large")
        if large.isEmpty():
            closed.append(placed.select("state", "word", "n"))
            discard(large)
            break
        closed.append(placed.join(large, "state", "left_anti").select("state", "word", "n"))
        open_ = materialise(placed.join(large, "state", "left_semi").select("word", "n"), "open")
        parts.append(_early_pairs(open_, depth, depth + step))
        depth, step = depth + step, step * 2
    placed = closed[0]
    for more in closed[1:]:
        placed = placed.unionByName(more)
    parts.append(placed.repartition("state").sortWithinPartitions("state", "word").mapInArrow(
        _compose, _PAIRS))
    pairs = parts[0]
    for more in parts[1:]:
        pairs = pairs.unionByName(more)
    return pairs


def _roots(forms):
    """(word, root) from (word, form): forms followed to the last, by doubling.

    A form occurs far more often than its word, so chains end and are short.
    """
    now = materialise(forms.withColumnRenamed("form", "root"), "roots")
    while True:
        ahead = now.select(F.col("word").alias("root"), F.col("root").alias("next"))
        then = materialise(now.join(ahead, "root", "left").select(
            "word", F.coalesce("next", "root").alias("root"),
            F.col("next").isNotNull().alias("moved")), "roots")
        moved = not then.where("moved").isEmpty()
        discard(now)
        now = then.drop("moved")
        if not moved:
            return now


def variants(words, ratio=10):
    """word, form, root, n, n_near, form_n for each row of ``words`` (word, n); others are ignored.

    The form is the near word of largest n (ties: smallest in code-point order) if its n is at
    least ``ratio`` times the word's; root follows forms to the last.  An empty table gives none.
    """
    near = near_pairs(words.select("word", "n"))
    best = near.groupBy("word").agg(
        F.count(F.lit(1)).alias("n_near"),
        F.min(F.struct((-F.col("other_n")).alias("less"), "other")).alias("best"))
    found = materialise(words.select("word", "n").join(best, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.expr(f"if(-best.less >= {ratio} * n, best.other, null)").alias("form"),
        F.expr(f"if(-best.less >= {ratio} * n, -best.less, null)").alias("form_n")), "variants")
    roots = _roots(found.where("form is not null").select("word", "form"))
    return found.join(roots, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def spelling_variants(documents, min_letters=7, min_count=2, ratio=10, noise=None):
    """The words of all texts with their near words, forms and roots; see ``vocabulary``, ``variants``.

    ``documents`` needs doc_id and text; further columns are ignored.  Repeated rows count again.
    """
    return variants(vocabulary(documents, min_letters, min_count, noise), ratio)


SQL = r"""
with recursive runs as materialized (
  select doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
         'abcdefghijklmnopqrstuvwxyz'), '[A-Za-z\x{00C0}-\x{00FF}]+')) as run
  from documents where text is not null),
counted as materialized (
  select run, hex(encode(coalesce(doc_id::varchar, '') || ':' || run)) as x, count(*) as n
  from runs where length(run) >= 7 group by all),
hashed as materialized (
  select run, n, xor(list_reduce(list_prepend(4294967295::bigint, list_transform(
           range(1, length(x), 2), lambda i: ('0x' || x[i:i + 1])::bigint)),
         lambda c, b: list_reduce(list_prepend(xor(c, b), range(8)),
           lambda d, k: xor(d >> 1, 3988292384 * (d & 1)))), 4294967295) as h from counted),
noisy as (
  select case when h % 31 = 0 then run[:h % length(run)] || run[h % length(run) + 2:]
         else run end as word, n from hashed),
words as materialized (
  select word, sum(n)::bigint as n from noisy where length(word) >= 7
  group by word having sum(n) >= 2),
cuts as materialized (
  select word, n, unnest(range(length(word))) as i, length(word) as l from words),
deleted as materialized (
  select word, n, i, word[:i] || word[i + 2:] as rest from cuts),
pairs as (
  select a.word, b.word as other, b.n as other_n from deleted a join deleted b
  on a.rest = b.rest and a.i = b.i and a.word <> b.word
  union select a.word, b.word, b.n from deleted a join words b on a.rest = b.word
  union select b.word, a.word, a.n from deleted a join words b on a.rest = b.word),
best as (
  select word, count(*) as n_near, max(other_n) as top from pairs group by word),
forms as materialized (
  select w.word, w.n, coalesce(b.n_near, 0)::bigint as n_near,
         (select min(p.other) from pairs p where p.word = w.word and p.other_n = b.top
            and b.top >= 10 * w.n) as form,
         case when b.top >= 10 * w.n then b.top end as form_n
  from words w left join best b using (word)),
chain(word, root) as (
  select word, word from forms
  union all select c.word, f.form from chain c join forms f on c.root = f.word
  where f.form is not null)
select f.word, f.form, c.root, f.n, f.n_near, f.form_n from forms f join chain c on f.word = c.word
join forms last on last.word = c.root and last.form is null
"""
