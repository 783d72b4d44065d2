"""Language-model scores of documents: Katz backoff with Good-Turing discounts.

The model has order 2: the probability of a token given the token before it.
Seen pairs get a Good-Turing discounted share of their history's count; what the
discounts free goes to the unseen tokens in proportion to the next lower order,
with a backoff weight that makes each history's probabilities add up to one
exactly. The lowest order is the additive unigram of the base score, in which all
unknown words are one class. A token's probability is evaluated from the pair
down to the unigram.

Documents are cut into chunks of about ``CHUNK`` tokens. A chunk asks for the
counts of its distinct words, then of its distinct pairs: requests go to buckets
(by word, by history), each bucket adds up what all chunks have counted and
answers each chunk for what it asked. So a word or pair that is everywhere is one
row a chunk, and a history with very many pairs is dealt over several buckets by
a rule on its count. Neither the vocabulary nor the pairs are ever broadcast or
collected; the driver sees sums.

Numbers travel in compressed columns of bytes (``packed``), as the tables of a
corpus are otherwise several times its size.

Defined results: a null or empty text is the end token alone; a null id counts as
the empty text for the held-out rule; repeated rows are documents of their own;
an empty table gives an empty table.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.plans.cut import written

CHUNK = 4_000_000
#: Entries that one bucket adds up, on average.
BUCKET = 1_000_000
#: Counts up to this one are discounted.
K = 5
ADDED = 0.1
#: Documents whose crc32 of the id has this remainder are held out.
FOLDS, HELD_OUT = 10, 0

_LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")


def packed(values: np.ndarray) -> bytes:
    """Whole numbers from 0 as compressed bytes, the planes of equal significance together."""
    values = np.ascontiguousarray(values, np.uint64)
    top = int(values.max(initial=0))
    width = 1 if top < 1 << 8 else 2 if top < 1 << 16 else 4 if top < 1 << 32 else 8
    planes = values.astype(f"<u{width}").view(np.uint8).reshape(-1, width).T
    return bytes([width]) + zstandard.compress(np.ascontiguousarray(planes).tobytes(), 3)


def unpacked(data: bytes) -> np.ndarray:
    width = data[0]
    planes = np.frombuffer(zstandard.decompress(data[1:]), np.uint8).reshape(width, -1)
    return np.ascontiguousarray(planes.T).view(f"<u{width}").ravel().astype(np.int64)


def _rising(values: np.ndarray) -> bytes:
    """Rising numbers by their steps."""
    return packed(np.diff(values, prepend=0))


def _risen(data: bytes) -> np.ndarray:
    return np.cumsum(unpacked(data))


def held_out(doc_id: object) -> bool:
    return zlib.crc32(b"" if doc_id is None else str(doc_id).encode()) % FOLDS == HELD_OUT


def discounts(counts: np.ndarray, k: int = K) -> np.ndarray:
    """Good-Turing factors for the counts 0 to ``k``; ``counts[r]`` is the number of pairs seen r times.

    The factors of counts above the largest usable limit are 1. Where the counts of
    counts give no factors between 0 and 1 (small corpora), half an occurrence is
    taken from each of the counts up to ``k``.
    """
    factors = np.ones(k + 1)
    for limit in range(k, 1, -1):
        n = counts[: limit + 2].astype(float)
        if (n[1 : limit + 1] > 0).all():
            common = (limit + 1) * n[limit + 1] / n[1]
            r = np.arange(1, limit + 1)
            ratio = (r + 1) * n[2 : limit + 2] / n[1 : limit + 1] / r
            found = (ratio - common) / (1 - common) if common != 1 else np.zeros(limit)
            if ((found > 0) & (found < 1)).all():
                factors[1 : limit + 1] = found
                return factors
    factors[1:] = 1 - 0.5 / np.arange(1, k + 1)
    return factors


CHUNKS = "chunk long, doc_ids binary, flags binary, sizes binary, tokens binary, hashes binary, counts binary"
#: What the tokens' side of a chunk consists of.
TOKENS = ["chunk", "doc_ids", "flags", "sizes", "tokens"]


def chunks(docs: DataFrame) -> DataFrame:
    """``CHUNKS``: documents as numbers of a chunk's own words.

    Word 0 of a chunk is the end token. ``counts`` are its words' training counts,
    ``flags`` of a document are 1 if it is held out and 2 if its id is null.
    """

    def chunk(number: int, ids: list, sizes: list, tokens: list, words: dict) -> pa.RecordBatch:
        sizes, own = np.array(sizes), np.concatenate(tokens)
        flags = np.array([held_out(i) + 2 * (i is None) for i in ids])
        training = np.repeat(flags & 1 == 0, sizes)
        # The empty word stands for the end token; no other word is empty.
        hashes = np.array([xxhash.xxh64_intdigest(w) for w in words], np.uint64)
        counts = np.bincount(own[training], minlength=len(words))
        doc_ids = np.array([0 if i is None else i for i in ids], "<i8").tobytes()
        values = [number, doc_ids, packed(flags), packed(sizes), packed(own), hashes.tobytes(), packed(counts)]
        types = [pa.int64(), *[pa.binary()] * 6]
        names = [c.split()[0] for c in CHUNKS.split(", ")]
        return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(values, types)], names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 24
        ids, sizes, tokens, words, held = [], [], [], {b"": 0}, 0
        for batch in batches:
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text")):
                known, new = words.setdefault, words.__len__
                own = [known(w, new()) for w in (text.as_py() or "").encode().translate(_LOWER).split()]
                own.append(0)
                ids.append(doc_id)
                sizes.append(len(own))
                tokens.append(np.array(own, np.int32))
                held += len(own)
                if held >= CHUNK:
                    yield chunk(number, ids, sizes, tokens, words)
                    ids, sizes, tokens, words, held, number = [], [], [], {b"": 0}, 0, number + 1
        if ids:
            yield chunk(number, ids, sizes, tokens, words)

    return docs.mapInArrow(run, CHUNKS)


def _spread(groups: np.ndarray, n: int) -> list[np.ndarray]:
    """The places of each group number below ``n``, in rising order."""
    order = np.argsort(groups, kind="stable")
    return np.split(order, np.searchsorted(groups[order], np.arange(1, n)))


ANSWERS = "kind string, chunk long, bucket int, a binary, b binary, c binary, d binary"


def _answers(rows: list[tuple]) -> pd.DataFrame:
    return pd.DataFrame(rows, columns=["kind", "chunk", "bucket", "a", "b", "c", "d"])


def word_counts(held: DataFrame, buckets: int) -> DataFrame:
    """Answers of kind ``word``: places of a chunk's words, their numbers and training counts.

    Numbers fall with the count, so that frequent words have small ones. A row of
    kind ``sum`` per bucket has its words and occurrences in training.
    """

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for number, data, own in zip(*(batch.column(c) for c in ("chunk", "hashes", "counts"))):
                hashes, counts = np.frombuffer(data.as_py(), np.uint64), unpacked(own.as_py())
                for bucket, at in enumerate(_spread((hashes >> np.uint64(32)) % np.uint64(buckets), buckets)):
                    if len(at):
                        yield pa.RecordBatch.from_arrays(
                            [
                                pa.array([bucket], pa.int32()),
                                pa.array([number.as_py()], pa.int64()),
                                pa.array([_rising(at)]),
                                pa.array([hashes[at].tobytes()]),
                                pa.array([packed(counts[at])]),
                            ],
                            ["bucket", "chunk", "places", "hashes", "counts"],
                        )

    def answer(key: tuple, asked: pd.DataFrame) -> pd.DataFrame:
        bucket = int(key[0])
        hashes = [np.frombuffer(x, np.uint64) for x in asked["hashes"]]
        words, which = np.unique(np.concatenate(hashes), return_inverse=True)
        counts = np.concatenate([unpacked(x) for x in asked["counts"]])
        total = np.bincount(which, weights=counts, minlength=len(words)).astype(np.int64)
        rank = np.empty(len(words), np.int64)
        rank[np.lexsort((words, -total))] = np.arange(len(words))
        numbers = rank * buckets + bucket
        ends = np.cumsum([len(x) for x in hashes])[:-1]
        rows = [
            ("word", chunk, bucket, places, packed(numbers[own]), packed(total[own]), None)
            for chunk, places, own in zip(asked["chunk"], asked["places"], np.split(which, ends))
        ]
        sums = np.array([np.count_nonzero(total), total.sum()])
        return _answers([*rows, ("sum", -1, bucket, packed(sums), None, None, None)])

    asked = held.select("chunk", "hashes", "counts").mapInArrow(
        ask, "bucket int, chunk long, places binary, hashes binary, counts binary"
    )
    return asked.groupBy("bucket").applyInPandas(answer, ANSWERS)


class Chunk:
    """One chunk's tokens with the numbers and counts of its words, and its distinct pairs.

    ``pairs`` are sorted by history and word (places in the chunk's own lists);
    histories are words, or ``start`` for the first token of a document.
    """

    def __init__(self, row: pd.Series, words: pd.DataFrame):
        flags = unpacked(row["flags"])
        self.held_out = flags & 1 == 1
        self.doc_ids = pd.array(np.frombuffer(row["doc_ids"], "<i8"), dtype="Int64")
        self.doc_ids[flags & 2 == 2] = pd.NA
        self.sizes, self.tokens = unpacked(row["sizes"]), unpacked(row["tokens"])
        n = sum(len(unpacked(x)) for x in words["a"])
        self.numbers, self.counts = np.zeros(n, np.int64), np.zeros(n, np.int64)
        for _, part in words.iterrows():
            at = _risen(part["a"])
            self.numbers[at], self.counts[at] = unpacked(part["b"]), unpacked(part["c"])
        # Word 0 is the end token, which is no history: it stands for the start.
        self.firsts = np.cumsum(self.sizes) - self.sizes
        history = np.empty_like(self.tokens)
        history[1:] = self.tokens[:-1]
        history[self.firsts] = 0
        self.keys, self.pair_of = np.unique(history * np.int64(n) + self.tokens, return_inverse=True)
        self.history, self.word = np.divmod(self.keys, np.int64(n))

    def training_counts(self) -> np.ndarray:
        training = np.repeat(~self.held_out, self.sizes)
        return np.bincount(self.pair_of[training], minlength=len(self.keys))

    def placed(self, buckets: int, n_train: int) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
        """``bucket, histories, number of pairs of each, pairs`` in an order that only the chunk's words decide.

        A history goes to one bucket, or to so many as its count is large; then
        every one of them hears of it, also where the chunk has no pair for it.
        """
        own = np.unique(self.history)
        parts = np.clip(-(-self.counts[own] * 4 * buckets // max(1, n_train)), 1, buckets)
        first = _mixed(self.numbers[own]) % buckets
        place = np.searchsorted(own, self.history)
        to = (first[place] + _mixed(self.numbers[self.word]) % parts[place]) % buckets
        spread = np.repeat(np.arange(len(own)), parts)
        turn = np.arange(len(spread)) - np.repeat(np.cumsum(parts) - parts, parts)
        told = _spread((first[spread] + turn) % buckets, buckets)
        for bucket, (at, pairs) in enumerate(zip(told, _spread(to, buckets))):
            if len(at):
                histories = spread[at]
                sizes = np.bincount(np.searchsorted(histories, place[pairs]), minlength=len(histories))
                yield bucket, own[histories], sizes, pairs


def _mixed(numbers: np.ndarray) -> np.ndarray:
    """Numbers spread over 31 bits."""
    mixed = numbers.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    return ((mixed ^ (mixed >> np.uint64(29))) >> np.uint64(33)).astype(np.int64)


#: What is known of a history: pairs seen 1 to K times, occurrences above, occurrences and number of the words seen.
FIELDS = K + 3


def pair_counts(held: DataFrame, words: DataFrame, buckets: int, n_train: int) -> DataFrame:
    """Answers of kind ``pair``: counts of a chunk's pairs, and of its histories what a bucket knows of them.

    A row of kind ``sum`` per bucket has the numbers of pairs seen 0 to ``K + 1`` times.
    """

    def ask(key: tuple, own: pd.DataFrame, known: pd.DataFrame) -> pd.DataFrame:
        rows = []
        if len(own):
            chunk = Chunk(own.iloc[0], known)
            counts = chunk.training_counts()
            for bucket, histories, sizes, pairs in chunk.placed(buckets, n_train):
                word = chunk.word[pairs]
                distinct, at = np.unique(chunk.numbers[word], return_index=True)
                rows.append(
                    (
                        bucket, int(key[0]), packed(chunk.numbers[histories]), packed(sizes),
                        packed(chunk.numbers[word]), packed(counts[pairs]), packed(chunk.counts[word[at]]),
                    )
                )
        return pd.DataFrame(rows, columns=["bucket", "chunk", "histories", "sizes", "words", "counts", "word_counts"])

    def answer(key: tuple, asked: pd.DataFrame) -> pd.DataFrame:
        own_histories = [unpacked(x) for x in asked["histories"]]
        histories, which = np.unique(np.concatenate(own_histories), return_inverse=True)
        sizes = np.concatenate([unpacked(x) for x in asked["sizes"]])
        words = [unpacked(x) for x in asked["words"]]
        per_word = []
        for own, counts in zip(words, asked["word_counts"]):
            per_word.append(unpacked(counts)[np.searchsorted(np.unique(own), own)])
        history, word = np.repeat(which, sizes), np.concatenate(words)
        lengths = [len(x) for x in words]
        order = np.lexsort((word, history))
        sorted_history, sorted_word = history[order], word[order]
        new = np.ones(len(order), bool)
        new[1:] = (sorted_history[1:] != sorted_history[:-1]) | (sorted_word[1:] != sorted_word[:-1])
        pair = np.empty(len(order), np.int64)
        pair[order] = np.cumsum(new) - 1
        counts = np.concatenate([unpacked(x) for x in asked["counts"]])
        total = np.bincount(pair, weights=counts, minlength=int(new.sum())).astype(np.int64)
        of, seen = sorted_history[new], total > 0
        word_count = np.concatenate(per_word)[order][new]
        known = np.zeros((FIELDS, len(histories)), np.int64)
        for r in range(1, K + 1):
            known[r - 1] = np.bincount(of[total == r], minlength=len(histories))
        high = total > K
        known[K] = np.bincount(of[high], weights=total[high], minlength=len(histories))
        known[K + 1] = np.bincount(of[seen], weights=word_count[seen], minlength=len(histories))
        known[K + 2] = np.bincount(of[seen], minlength=len(histories))
        bucket, rows = int(key[0]), []
        ends = np.cumsum([len(x) for x in own_histories])[:-1]
        for chunk, own, at in zip(asked["chunk"], np.split(pair, np.cumsum(lengths)[:-1]), np.split(which, ends)):
            rows.append(("pair", chunk, bucket, packed(total[own]), packed(known[:, at].ravel()), None, None))
        sums = np.bincount(np.minimum(total, K + 2), minlength=K + 3)[: K + 2]
        return _answers([*rows, ("sum", -1, bucket, packed(sums), None, None, None)])

    asked = (
        held.select(*TOKENS)
        .groupBy("chunk")
        .cogroup(words.where("kind = 'word'").groupBy("chunk"))
        .applyInPandas(
            ask, "bucket int, chunk long, histories binary, sizes binary, words binary, counts binary, word_counts binary"
        )
    )
    return asked.groupBy("bucket").applyInPandas(answer, ANSWERS)


class Model:
    """The sums of the corpus that every token's probability rests on."""

    def __init__(self, words: int, n_train: int, factors: np.ndarray):
        self.n_train, self.factors = n_train, factors
        self.all = n_train + ADDED * (words + 1)

    def unigram(self, count: np.ndarray) -> np.ndarray:
        return (count + ADDED) / self.all

    def weights(self, known: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For histories with ``FIELDS`` numbers each: factor of their seen pairs, and backoff weight.

        Where no pair's count is discounted, one occurrence more than there are goes to unseen tokens.
        """
        r = np.arange(1, K + 1)[:, None]
        mass = (known[:K] * r).sum(0) + known[K]
        kept = (known[:K] * r * self.factors[1:, None]).sum(0) + known[K]
        none = kept >= mass
        scale = np.where(none, mass / (mass + 1.0), 1.0) / np.maximum(mass, 1)
        left = np.where(mass > 0, 1 - kept * scale, 1.0)
        unseen = 1 - (known[K + 1] + ADDED * known[K + 2]) / self.all
        return scale, left / unseen

    def probability(self, count: np.ndarray, word_count: np.ndarray, scale: np.ndarray, weight: np.ndarray) -> np.ndarray:
        """Of tokens given their history: the discounted share of a seen pair, else back off."""
        seen = count * np.append(self.factors, 1.0)[np.minimum(count, K + 1)] * scale
        return np.where(count > 0, seen, weight * self.unigram(word_count))


def score(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score`` for every document."""
    rows = docs.select(F.col(f"`{doc_id}`").cast("long").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    held = written(chunks(rows), "lm-chunks")
    size = F.coalesce(F.sum(F.length("hashes")), F.lit(0)) / 8
    entries = held.agg(size).first()[0]
    words = written(word_counts(held, max(1, int(entries // BUCKET))), "lm-words")
    n_words, n_train = _sums(words, 2)
    # Pairs of a chunk are at most its tokens; these are as many as its training words and a tenth.
    buckets = max(1, int(n_train * FOLDS // (FOLDS - 1) // BUCKET))
    pairs = written(pair_counts(held, words, buckets, n_train), "lm-pairs")
    model = Model(n_words, n_train, discounts(np.array(_sums(pairs, K + 2))))

    def evaluate(key: tuple, own: pd.DataFrame, known: pd.DataFrame) -> pd.DataFrame:
        names = ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"]
        if own.empty:
            return pd.DataFrame({n: [] for n in names})
        chunk = Chunk(own.iloc[0], known[known["kind"] == "word"])
        found = known[known["kind"] == "pair"].set_index("bucket")
        counts = np.zeros(len(chunk.keys), np.int64)
        fields = np.zeros((FIELDS, len(chunk.numbers)), np.int64)
        for bucket, histories, _, pairs_at in chunk.placed(buckets, n_train):
            row = found.loc[bucket]
            counts[pairs_at] = unpacked(row["a"])
            # A history dealt over buckets has a part of its pairs in each.
            fields[:, histories] += unpacked(row["b"]).reshape(FIELDS, -1)
        scale, weight = model.weights(fields)
        word_count = chunk.counts[chunk.word]
        each = np.log10(model.probability(counts, word_count, scale[chunk.history], weight[chunk.history]))
        base = np.log10(model.unigram(word_count))
        of_token = chunk.pair_of
        return pd.DataFrame(
            {
                "doc_id": chunk.doc_ids,
                "held_out": chunk.held_out,
                "n_tokens": chunk.sizes,
                "n_known": np.add.reduceat((word_count > 0)[of_token].astype(np.int64), chunk.firsts),
                "train_tokens": n_train,
                "base_score": np.add.reduceat(base[of_token], chunk.firsts),
                "score": np.add.reduceat(each[of_token], chunk.firsts),
            }
        )

    known = words.where("kind = 'word'").unionByName(pairs.where("kind = 'pair'"))
    return (
        held.select(*TOKENS)
        .groupBy("chunk")
        .cogroup(known.groupBy("chunk"))
        .applyInPandas(
            evaluate,
            "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double",
        )
    )


def _sums(answers: DataFrame, n: int) -> list[int]:
    """The ``n`` sums of all buckets' ``sum`` rows, added up in tasks first."""

    def add(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros(n, np.int64)
        for batch in batches:
            for data in batch["a"]:
                total += unpacked(data)
        yield pd.DataFrame({f"s{i}": [v] for i, v in enumerate(total)})

    schema = ", ".join(f"s{i} long" for i in range(n))
    sums = answers.where("kind = 'sum'").select("a").mapInPandas(add, schema)
    return [v or 0 for v in sums.agg(*[F.sum(f"s{i}") for i in range(n)]).first()]
