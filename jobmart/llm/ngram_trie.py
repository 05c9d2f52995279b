"""Language-model scores from a sharded Elias-Fano n-gram trie.

Model. Bigrams with a Dirichlet prior: P(w | v) = (c(v, w) + MU * P1(w)) / (c(v) + MU), and P1(w) = (c(w) + 0.5)
/ (N + 0.5 (V + 1)) with one share for all unknown words; both sum to one. Counts are those of all training
texts, nothing is pruned. In the logarithm the denominator stands by itself, so all that a token needs
besides c(v) belongs to its word w, and a text's score is a sum over words in any order.

Trie. Words are dealt to shards by hash. A shard's trie has the words (level 1), for each a pointer to its
predecessors, and the predecessors as hashes relative to their word (level 2; 48 bits, or the bits that 64 leave beside the
number of a word where a shard has over 65,536 words). Both levels and
the pointers are monotone, held in Elias-Fano form; the smoothed log probabilities are quantised to steps
of 2**-10 in 16 bits. All arrays lie in one memory-mapped file. A query finds the word, then the successor of
the predecessor's hash among those of that word, by binary search in that context's range.

Spark. One job counts words (each task merges its texts first) for N and V, and finds the hot words: those with more
than a shard's share of all tokens, at most as many as there are shards, known to all tasks. A second job sends each
block of texts as its distinct pairs of word and predecessor with their training counts to the word's shard, a hot
word's pairs to shards by word and predecessor. So no shard gets a pair more than once a block, however common it is. The
shard merges the counts, builds its trie and answers each block with a code a pair. The block's texts, read once more, are
scored with the answers. No text, table of words or model passes through the driver.
"""

from __future__ import annotations

import mmap
import tempfile
import zlib

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from jobmart.llm.common import partitions, pieces, stored, words_of

MU = 500.0
STEP = 2.0 ** -10
#: Tokens that a task gathers before it sends them.
BLOCK_TOKENS = 1_000_000
#: Bits of a predecessor's hash.
BEFORE_BITS = 48
#: Code of a pair that the training texts lack.
UNSEEN = 65535
#: Hashes of the end of a text, and of its start as a predecessor.
END, START = np.uint64(0xE5D0E5D0E5D0E5D1), np.uint64(0x57A2757A2757A271)


def tokens(text: str | None) -> np.ndarray:
    """Hashes of the words with A-Z in lower case, then the end."""
    words = [w.lower() for w in words_of(text)]
    h = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
    return np.append(h, END)


def in_training(doc_id: int | None) -> bool:
    return zlib.crc32(str(doc_id).encode()) % 5 != 1


class EliasFano:
    """Ascending unsigned integers: low bits packed, high parts in unary with a rank for each 64 bits."""

    def __init__(self, values: np.ndarray, put):
        values = np.ascontiguousarray(values, np.uint64)
        self.n = n = len(values)
        top = int(values[-1]) if n else 0
        self.low_bits = low = max(0, (top // max(1, n)).bit_length() - 1)
        self.width = -(-low // 8)  # low parts in whole bytes
        self.low_bits = low = 8 * self.width
        self.low = put(values.view(np.uint8).reshape(n, 8)[:, :self.width].reshape(-1))
        ones = (values >> np.uint64(low) if low < 64 else values * np.uint64(0)) + np.arange(n, dtype=np.uint64)
        words = np.zeros((int(ones[-1]) >> 6) + 1 if n else 0, np.uint64)
        np.bitwise_or.at(words, (ones >> np.uint64(6)).astype(np.int64), np.uint64(1) << (ones & np.uint64(63)))
        self.words = put(words)
        counts = np.bitwise_count(words).astype(np.uint32)
        self.ranks = put(np.cumsum(counts, dtype=np.uint32) - counts)

    def get(self, i: np.ndarray) -> np.ndarray:
        word = np.searchsorted(self.ranks, i, side="right") - 1
        bits, left = self.words[word], (i - self.ranks[word]).astype(np.uint64)
        place = np.zeros(len(i), np.uint64)
        for half in (32, 16, 8, 4, 2, 1):  # select the left-th one of the word
            below = np.bitwise_count(bits >> place & np.uint64((1 << half) - 1)).astype(np.uint64)
            right = below <= left
            place += np.where(right, np.uint64(half), np.uint64(0))
            left -= np.where(right, below, np.uint64(0))
        high = (word.astype(np.uint64) << np.uint64(6)) + place - i.astype(np.uint64)
        out = high << np.uint64(self.low_bits) if self.low_bits < 64 else np.zeros(len(i), np.uint64)
        for k in range(self.width):
            out |= self.low[i * self.width + k].astype(np.uint64) << np.uint64(8 * k)
        return out

    def successor(self, x: np.ndarray, first: np.ndarray, last: np.ndarray) -> np.ndarray:
        """The least i in [first, last) with a value of x or more, else last."""
        lo, hi = first.astype(np.int64).copy(), last.astype(np.int64).copy()
        open_ = np.flatnonzero(lo < hi)
        while len(open_):
            mid = (lo[open_] + hi[open_]) >> 1
            less = self.get(mid) < x[open_]
            lo[open_[less]], hi[open_[~less]] = mid[less] + 1, mid[~less]
            open_ = open_[lo[open_] < hi[open_]]
        return lo


class Trie:
    """One shard. ``words`` ascending with their counts; pairs (word index, predecessor of ``bits`` bits) ascending."""

    def __init__(self, words: np.ndarray, counts: np.ndarray, pair_word: np.ndarray, pair_before: np.ndarray, pair_counts: np.ndarray,
                 total: float, mu: float = MU, bits: int = BEFORE_BITS):
        self.file = tempfile.TemporaryFile()  # gone with the task
        self.size = 0
        pending: list[np.ndarray] = []

        def put(a: np.ndarray):
            pending.append(a)
            return len(pending) - 1

        self.bits = np.uint64(bits)
        p1 = (counts + 0.5) / total
        starts = np.searchsorted(pair_word, np.arange(len(words) + 1))
        self.words = EliasFano(words, put)
        self.pointers = EliasFano(starts, put)
        self.before = EliasFano(pair_word.astype(np.uint64) << self.bits | pair_before, put)
        self.p1, self.context = put(_quantised(np.log10(p1))), put(_quantised(np.log10(counts + mu)))
        self.p2 = put(_quantised(np.log10(pair_counts + mu * p1[pair_word])))
        self.counts = put(counts.astype(np.int64))
        places = []
        for a in pending:
            data = np.ascontiguousarray(a)
            places.append((self.size, data.dtype, len(data)))
            self.file.write(data.tobytes() + bytes(-data.nbytes % 8))
            self.size += data.nbytes + -data.nbytes % 8
        self.file.write(bytes(8))
        self.file.flush()
        self.map = mmap.mmap(self.file.fileno(), 0, access=mmap.ACCESS_READ)
        level = lambda k: np.frombuffer(self.map, places[k][1], places[k][2], places[k][0])
        for ef in (self.words, self.pointers, self.before):
            ef.low, ef.words, ef.ranks = level(ef.low), level(ef.words), level(ef.ranks)
        self.p1, self.context, self.p2, self.counts = map(level, (self.p1, self.context, self.p2, self.counts))

    def find(self, words: np.ndarray) -> np.ndarray:
        """The index of each word, -1 if the training texts lack it."""
        n = np.full(len(words), self.words.n)
        at = self.words.successor(words, np.zeros(len(words), np.int64), n)
        known = at < n
        known[known] = self.words.get(at[known]) == words[known]
        return np.where(known, at, -1)

    def codes(self, node: np.ndarray, before: np.ndarray) -> np.ndarray:
        """Code of log10(c(v, w) + mu P1(w)) for each (index of w, hash of v), UNSEEN without such a pair."""
        out = np.full(len(node), UNSEEN, np.uint16)
        known = np.flatnonzero(node >= 0)
        node, key = node[known], node[known].astype(np.uint64) << self.bits | before[known]
        first, last = self.pointers.get(node).astype(np.int64), self.pointers.get(node + 1).astype(np.int64)
        at = self.before.successor(key, first, last)
        seen = at < last
        seen[seen] = self.before.get(at[seen]) == key[seen]
        out[known[seen]] = self.p2[at[seen]]
        return out


def _quantised(x: np.ndarray) -> np.ndarray:
    return np.clip(np.rint((x + 32) / STEP), 0, UNSEEN - 1).astype(np.uint16)


def _value(code: np.ndarray) -> np.ndarray:
    return code.astype(np.float64) * STEP - 32


def _planes(a: np.ndarray) -> bytes:
    """All first bytes of the numbers, then all second ones, so that small numbers compress in the shuffle."""
    a = np.ascontiguousarray(a)
    return a.view(np.uint8).reshape(len(a), a.itemsize).T.tobytes()


def _numbers(data: bytes, kind: type) -> np.ndarray:
    size = np.dtype(kind).itemsize
    return np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(size, -1).T).view(kind).reshape(-1)


def _firsts(*columns: np.ndarray) -> np.ndarray:
    """Places where a row of sorted columns differs from the one before."""
    new = np.ones(len(columns[0]), bool)
    new[1:] = np.logical_or.reduce([c[1:] != c[:-1] for c in columns])
    return np.flatnonzero(new)


def _summed(words: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct words ascending and the sums of their columns of counts."""
    order = np.argsort(words, kind="stable")
    words = words[order]
    first = _firsts(words)
    return words[first], np.add.reduceat(counts[:, order], first, axis=1) if len(first) else counts


def _shard(h: np.ndarray, shards: int) -> np.ndarray:
    return ((h >> np.uint64(40)) % np.uint64(shards)).astype(np.int64)


def _arrow(rows: list[tuple], types: dict[str, pa.DataType]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], t) for k, t in enumerate(types.values())], list(types))


def _blocks(batches):
    """(ids, tokens of each text) of about ``BLOCK_TOKENS`` tokens, whole texts."""
    ids, held, n = [], [], 0
    for b in pieces(batches):
        for doc, x in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
            ids.append(doc)
            held.append(tokens(x))
            n += len(held[-1])
            if n >= BLOCK_TOKENS:
                yield ids, held
                ids, held, n = [], [], 0
    if held:
        yield ids, held


class Totals:
    """N, V and the number of training texts; hot words ascending with their training counts."""

    def __init__(self, n: int, v: int, texts: int, hot: np.ndarray, hot_counts: np.ndarray):
        self.n, self.v, self.texts, self.hot, self.hot_counts = n, v, texts, hot, hot_counts
        self.total = n + 0.5 * (v + 1)

    def place(self, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Whether each word is hot, and where it stands among the hot words."""
        at = np.searchsorted(self.hot, words)
        hot = at < len(self.hot)
        hot[hot] = self.hot[at[hot]] == words[hot]
        return hot, at


def totals(rows: DataFrame, shards: int) -> Totals:
    """Counts of all words. Every block sends each of its words once; the driver gets sums and the hot words."""

    def count(batches):
        types = {"shard": pa.int32(), "words": pa.binary(), "train": pa.binary(), "every": pa.binary()}
        for ids, held in _blocks(batches):
            train = np.repeat([in_training(d) for d in ids], [len(x) for x in held])
            words, inverse = np.unique(np.concatenate(held), return_inverse=True)
            counts = np.bincount(inverse, train, len(words)).astype(np.uint32), np.bincount(inverse, minlength=len(words)).astype(np.uint32)
            shard = _shard(words, shards)
            order = np.argsort(shard, kind="stable")
            ends = np.append(_firsts(shard[order]), len(order))
            cut = [order[i:j] for i, j in zip(ends[:-1], ends[1:], strict=True)]
            yield _arrow([(int(shard[o[0]]), words[o].tobytes(), _planes(counts[0][o]), _planes(counts[1][o])) for o in cut], types)

    long_list = pa.list_(pa.int64())
    kinds = {"n": pa.int64(), "v": pa.int64(), "texts": pa.int64(), "tokens": pa.int64(), "words": long_list, "train": long_list, "every": long_list}

    def merge(batches):
        def done():
            words, counts = _summed(np.concatenate([w for w, _ in held]), np.concatenate([c for _, c in held], axis=1))
            n = int(counts[1].sum())
            often = counts[1] > n // shards
            return (int(counts[0].sum()), int((counts[0] > 0).sum()), int(counts[0][words == END].sum()), n,
                    words[often].view(np.int64), counts[0][often], counts[1][often])

        now, held, raw, kept = None, [], 0, 0
        out = []
        for b in batches:
            for i in range(b.num_rows):
                s = b.column(0)[i].as_py()
                if held and s != now:
                    out.append(done())
                    held, raw, kept = [], 0, 0
                now = s
                words = np.frombuffer(b.column(1)[i].as_py(), np.uint64)
                held.append((words, np.stack([_numbers(b.column(k)[i].as_py(), np.uint32).astype(np.int64) for k in (2, 3)])))
                raw += len(words)
                if raw > max(1_000_000, kept):  # merged when as much came again: each word moves a few times only
                    held = [_summed(np.concatenate([w for w, _ in held]), np.concatenate([c for _, c in held], axis=1))]
                    raw, kept = 0, len(held[0][0])
        if held:
            out.append(done())
        yield _arrow(out, kinds)

    sent = rows.mapInArrow(count, "shard int, words binary, train binary, every binary").repartitionById(shards, "shard").sortWithinPartitions("shard")
    lists = ", ".join(f"{c} array<long>" for c in ("words", "train", "every"))
    table = stored(sent.mapInArrow(merge, f"n long, v long, texts long, tokens long, {lists}"), "ngram-totals")
    n, v, texts, every = (x or 0 for x in table.agg(F.sum("n"), F.sum("v"), F.sum("texts"), F.sum("tokens")).first())
    word = F.explode(F.arrays_zip("words", "train", "every")).alias("w")
    hot = table.select(word).where(F.col("w.every") * shards > every).select("w.words", "w.train").collect()  # at most one a shard
    words = np.array([r.words for r in hot], np.int64).view(np.uint64)
    order = np.argsort(words)
    return Totals(n, v, texts, words[order], np.array([r.train for r in hot], np.int64)[order])


class Pairs:
    """The distinct pairs of a block by shard, word and predecessor, and the pair of each token."""

    def __init__(self, held: list[np.ndarray], known: Totals, shards: int):
        words = np.concatenate(held)
        before = np.concatenate([np.concatenate([[START], x[:-1]]) for x in held]) & np.uint64((1 << BEFORE_BITS) - 1)
        hot, _ = known.place(words)
        spread = (words ^ before * np.uint64(0x9E3779B97F4A7C15)) * np.uint64(0xD6E8FEB86659FD93)
        shard = _shard(np.where(hot, spread, words), shards)
        order = np.lexsort((before, words, shard))
        shard, words, before = shard[order], words[order], before[order]
        self.first = _firsts(shard, words, before)
        self.order = order
        self.shard, self.words, self.before = shard[self.first], words[self.first], before[self.first]
        of = np.zeros(len(order), np.uint32)
        of[self.first[1:]] = 1
        self.of_token = np.empty(len(order), np.uint32)
        self.of_token[order] = np.cumsum(of, dtype=np.uint32)

    def checksum(self) -> int:
        """Tells whether a block read again is the same."""
        return xxhash.xxh3_64_intdigest(self.of_token.tobytes() + self.words.tobytes()) >> 1


def _answers(messages: list[dict], known: Totals, mu: float):
    """One shard: merges the counts of its pairs, builds the trie, asks it for the pairs of each block."""
    word = [np.frombuffer(x["words"], np.uint64) for x in messages]
    size = [_numbers(x["sizes"], np.uint32) for x in messages]
    every = np.unique(np.concatenate(word))
    bits = min(BEFORE_BITS, 64 - int(len(every)).bit_length())
    keys = []
    for x, w, n in zip(messages, word, size, strict=True):
        wide = np.zeros((int(n.sum()), 8), np.uint8)
        wide[:, :BEFORE_BITS // 8] = np.frombuffer(x["before"], np.uint8).reshape(-1, BEFORE_BITS // 8)
        before = wide.view(np.uint64).reshape(-1) >> np.uint64(BEFORE_BITS - bits)
        keys.append(np.repeat(np.searchsorted(every, w).astype(np.uint64), n) << np.uint64(bits) | before)
    pairs, inverse = np.unique(np.concatenate(keys), return_inverse=True)
    counts = np.bincount(inverse, np.concatenate([_numbers(x["counts"], np.uint32) for x in messages]), len(pairs))
    pair_word, pair_before = (pairs >> np.uint64(bits)).astype(np.int64), pairs & np.uint64((1 << bits) - 1)
    word_counts = np.bincount(pair_word, counts, len(every))
    hot, at = known.place(every)
    word_counts[hot] = known.hot_counts[at[hot]]  # the other pairs of a hot word are elsewhere
    trained, seen = word_counts > 0, counts > 0
    new = np.cumsum(trained) - 1
    trie = Trie(every[trained], word_counts[trained], new[pair_word[seen]], pair_before[seen], counts[seen], known.total, mu, bits)
    node = trie.find(every)
    code = trie.codes(node[pair_word], pair_before)
    found = node >= 0
    c, p1, context = np.zeros(len(every), np.int64), np.zeros(len(every), np.uint16), np.full(len(every), _quantised(np.log10(mu)))
    c[found], p1[found], context[found] = trie.counts[node[found]], trie.p1[node[found]], trie.context[node[found]]
    context[every == END] = _quantised(np.float64(0.0))  # nothing follows the end
    done = 0
    for x, w, n, own in zip(messages, word, size, keys, strict=True):
        at, i = np.searchsorted(every, w), inverse[done:done + len(own)]
        done += len(own)
        yield (x["shard"], x["block"], x["check"], code[i].tobytes(), _planes(n), _planes(c[at]), _planes(p1[at]), _planes(context[at]))


def scores(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", mu: float = MU) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score and score of each whole text.

    Texts with crc32(doc_id as text) mod 5 other than 1 are the training texts (a null id counts as the text
    "None"). Tokens are the words (A-Z in lower case) and one end; a null text has the end alone. base_score is the sum of
    log10 P1 over the tokens, score the model's log10 probability. Without training texts N and V are 0.
    Rows with equal ids are scored one by one. An empty table gives an empty result.

    ``docs`` is read three times and its rows must come in the same partitions and order, as those of files do; a job whose
    blocks differ between two readings fails. Store a table that comes out of a shuffle first.
    """
    shards = partitions(docs.sparkSession)
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    known = totals(rows, shards)
    asked = {"shard": pa.int32(), "block": pa.int64(), "check": pa.int64(), "words": pa.binary(), "sizes": pa.binary(), "before": pa.binary(), "counts": pa.binary()}
    answered = {"shard": pa.int32(), "block": pa.int64(), "check": pa.int64()} | dict.fromkeys(("code", "sizes", "c", "p1", "context"), pa.binary())
    whole = {"block": pa.int64(), "check": pa.int64()} | dict.fromkeys(("of_token", "lengths", "ids", "null"), pa.binary())
    ddl = lambda types: ", ".join(f"{c} {'binary' if t == pa.binary() else 'int' if t == pa.int32() else 'long'}" for c, t in types.items())

    def numbered(batches):
        from pyspark import TaskContext
        for i, (ids, held) in enumerate(_blocks(batches)):
            yield TaskContext.get().partitionId() << 24 | i, ids, held, Pairs(held, known, shards)

    def ask(batches):
        for block, ids, held, pairs in numbered(batches):
            train = np.repeat([in_training(d) for d in ids], [len(x) for x in held])[pairs.order]
            counts = np.add.reduceat(train, pairs.first, dtype=np.uint32)
            group = _firsts(pairs.shard, pairs.words)
            sizes = np.diff(np.append(group, len(pairs.words))).astype(np.uint32)
            before = pairs.before.view(np.uint8).reshape(-1, 8)[:, :BEFORE_BITS // 8]
            check, out = pairs.checksum(), []
            cuts = np.append(_firsts(pairs.shard), len(pairs.shard))
            for i, j in zip(cuts[:-1], cuts[1:], strict=True):
                own = slice(*np.searchsorted(group, (i, j)))
                out.append((int(pairs.shard[i]), block, check, pairs.words[group[own]].tobytes(), _planes(sizes[own]), before[i:j].tobytes(), _planes(counts[i:j])))
            yield _arrow(out, asked)

    def answer(batches):
        now, held = None, []
        for b in batches:
            for x in b.to_pylist():
                if held and x["shard"] != now:
                    yield from (_arrow([r], answered) for r in _answers(held, known, mu))
                    held = []
                now = x["shard"]
                held.append(x)
        if held:
            yield from (_arrow([r], answered) for r in _answers(held, known, mu))

    def read_again(batches):
        for block, ids, held, pairs in numbered(batches):
            yield _arrow([(block, pairs.checksum(), _planes(pairs.of_token), np.array([len(x) for x in held], np.uint32).tobytes(),
                           np.array([-1 if d is None else d for d in ids], np.int64).tobytes(), np.array([d is None for d in ids]).tobytes())], whole)

    def add(batches):
        """A block's texts and the answers to its pairs, in the order of the shards, come together."""
        types = {"doc_id": pa.int64(), "n_tokens": pa.int64(), "n_known": pa.int64(), "base_score": pa.float64(), "part": pa.float64()}

        def done(rows):
            texts, parts = rows[0], rows[1:]
            if texts["of_token"] is None or any(x["check"] != texts["check"] for x in parts):
                raise ValueError("the texts came in another order when read again; store the table first")
            joined = lambda c, kind: np.concatenate([_numbers(x[c], kind) for x in parts])
            c, sizes = joined("c", np.int64), joined("sizes", np.uint32)
            p1 = np.where(c > 0, _value(joined("p1", np.uint16)), np.log10(0.5 / known.total)) + np.log10(mu)
            base, context = np.log10((c + 0.5) / known.total), _value(joined("context", np.uint16))
            code = np.concatenate([np.frombuffer(x["code"], np.uint16) for x in parts])
            word = np.repeat(np.arange(len(c)), sizes)
            value = np.where(code == UNSEEN, p1[word], _value(code)) - context[word]
            pair = _numbers(texts["of_token"], np.uint32)
            lengths = np.frombuffer(texts["lengths"], np.uint32)
            owner, null = np.repeat(np.arange(len(lengths)), lengths), np.frombuffer(texts["null"], bool)
            total = lambda x: np.bincount(owner, x[pair], len(lengths))
            return pa.RecordBatch.from_arrays(
                [pa.array(np.frombuffer(texts["ids"], np.int64), mask=null), pa.array(lengths.astype(np.int64)), pa.array(total((c > 0)[word]).astype(np.int64)),
                 pa.array(total(base[word])), pa.array(total(value))], list(types))

        held = []
        for b in batches:
            for x in b.to_pylist():
                if held and x["block"] != held[0]["block"]:
                    yield done(held)
                    held = []
                held.append(x)
        if held:
            yield done(held)

    asks = rows.mapInArrow(ask, ddl(asked)).repartitionById(shards, "shard").sortWithinPartitions("shard")
    answers = asks.mapInArrow(answer, ddl(answered))
    texts = rows.mapInArrow(read_again, ddl(whole)).withColumn("shard", F.lit(-1))
    met = texts.unionByName(answers, allowMissingColumns=True).repartition(shards, "block").sortWithinPartitions("block", "shard")
    summed = met.mapInArrow(add, "doc_id long, n_tokens long, n_known long, base_score double, part double")
    start = float(np.log10(known.texts + mu))
    crc = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("None")).cast("binary"))
    return summed.select("doc_id", (crc % 5 == 1).alias("held_out"), "n_tokens", "n_known", F.lit(known.n).cast("long").alias("train_tokens"),
                         "base_score", (F.col("part") - start).alias("score"))
