"""Language-model scores by a weighted backoff automaton.

Model: n-grams of order up to ``order`` (two by default), counted over all
training texts without cut-off, smoothed by a Dirichlet prior on the next
lower order:

    p1(w)   = (c(w) + 0.5) / (N + 0.5 (V + 1))
    pk(w|h) = (c(h w) + mu p(k-1)(w|h')) / (c(h) + mu)

As an automaton: a state for each context h, an arc for each n-gram h w that
training has (weight log10 pk), a failure arc from h to its suffix h' (weight
log10 of mu / (c(h) + mu)).  The state without context has an arc for every
token.  A text is read once from left to right; each token takes an arc, after
as many failure arcs as needed, and the state that it leads to is carried on,
with the log-probability so far.  A text begins in the state of the context
before its first token.

Scale.  The model grows with the corpus, so it is neither collected nor
broadcast.  Documents are dealt into blocks of about ``BLOCK_BYTES`` by a hash
of id and text.  Each block sends its distinct n-grams with their training
counts to model partitions (ranges of the n-gram hash); a partition adds them
up and answers every block with what others add to the counts that it sent,
in the order sent, so the answer needs no keys.  A block then builds the part of
the automaton that its texts can reach and traverses it.  Hot words are one row
for each block.  A block sends nothing to a partition of which it has no n-gram,
so there are at most as many rows as distinct n-grams of the blocks, which grow
in proportion to the input.  What every block must know, N, V and the number of
training texts, is summed by an aggregate of its own and reaches a block as one
row.  Blocks, partitions and their number grow with the input; one block or
partition is one task's unit of bounded size (a single longer text is a block's
excess).  Everything is one plan of shuffles, which survives lost executors.

N-grams are known by 64-bit hashes: of n distinct ones about n^2 / 2^65 pairs
collide, e.g. one in ten thousand corpora of 6e7 n-grams has such a pair.

Edge cases: null and empty texts have the end token alone.  Rows are scored
one by one, repeated rows too.  Without training rows every token has
p = 0.5 / (0.5 (0 + 1)) = 1.  An empty table gives an empty result.  A row's
other columns are not carried along; join them by id.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema

from candlewick.llm.common import bounded_batches

ORDER = 2
MU = 100.0
BLOCK_BYTES = 4 << 20
PARTITION_KEYS = 2 << 20
BYTES_A_TOKEN = 6  # about; only sizes partitions

_SENT = "gram int, part int, block int, keys binary, counts binary"
_ANSWER = "block int, gram int, part int, others binary"
_SIZES = "tokens long, distinct long, ends long"


def mix(context, token):
    """Hash of a context's hash and a token's (numpy, unsigned 64-bit)."""
    import numpy as np

    x = context * np.uint64(0x9E3779B97F4A7C15) + token
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _word(w: bytes, seed: int = 0) -> int:
    import xxhash

    return xxhash.xxh64_intdigest(w, seed)


def _edge(k: int):
    """Stands for the context before a text's first token, as a gram of order k."""
    import numpy as np

    return np.uint64(_word(b"", 100 + k))


def end_key() -> int:
    return _word(b"", 1)


def grams_of(texts: list, order: int):
    """Hashes of the n-grams that end at each token of the texts, for each
    order, and the offset of each text's first token."""
    import numpy as np

    known: dict[bytes, int] = {b"": 0}  # no word is empty: the end token
    seq, first = [], [0]
    index = known.setdefault
    for t in texts:
        if t:
            seq += [index(w, len(known)) for w in t.encode().lower().split()]
        seq.append(0)
        first.append(len(seq))
    keys = np.array([end_key()] + [_word(w) for w in known if w], np.uint64)
    token = keys[np.array(seq, np.int64)] if seq else np.zeros(0, np.uint64)
    first = np.array(first, np.int64)
    grams, contexts = [token], [None]
    for k in range(1, order):
        context = np.empty_like(token)
        context[1:] = grams[-1][:-1]
        context[first[:-1]] = _edge(k)
        contexts.append(context)
        grams.append(mix(context, token))
    return grams, contexts, first


def pack(x) -> bytes:
    """Counts in the fewest bytes each (the length tells how many), compressed."""
    import numpy as np
    import zstandard

    top = int(x.max()) if len(x) else 0
    kind = next(k for k in (np.uint8, np.uint16, np.uint32, np.uint64) if top <= np.iinfo(k).max)
    return zstandard.compress(x.astype(kind).tobytes(), 1)


def unpack(raw: bytes, n: int):
    import numpy as np
    import zstandard

    raw = zstandard.decompress(raw)
    return np.frombuffer(raw, f"u{len(raw) // n}").astype(np.int64) if n else np.zeros(0, np.int64)


def pack_keys(keys) -> bytes:
    """Sorted keys as differences, the bytes of equal weight together: the high ones are nearly all zero."""
    import numpy as np
    import zstandard

    steps = np.diff(keys, prepend=np.uint64(0))
    return zstandard.compress(np.ascontiguousarray(steps.view(np.uint8).reshape(-1, 8).T).tobytes(), 1)


def unpack_keys(raw: bytes):
    import numpy as np
    import zstandard

    planes = np.frombuffer(zstandard.decompress(raw), np.uint8).reshape(8, -1)
    return np.cumsum(np.ascontiguousarray(planes.T).view(np.uint64).ravel(), dtype=np.uint64)


def _cuts(keys, parts: int):
    """Where the ranges of the sorted keys begin; ``parts`` is a power of two."""
    import numpy as np

    shift = np.uint64(64 - parts.bit_length() + 1)
    return np.searchsorted(keys >> shift if parts > 1 else np.zeros(len(keys), np.uint64),
                           np.arange(parts + 1, dtype=np.uint64))


def _sender(order: int, parts: list[int]):
    def send(key, rows):
        """One block: its distinct n-grams with training counts, by model partition."""
        import numpy as np

        grams, _, first = grams_of(rows["text"].to_pylist(), order)
        train = np.repeat(np.asarray(rows["train"].to_pylist(), np.float64), np.diff(first))
        out: dict[str, list] = {"gram": [], "part": [], "block": [], "keys": [], "counts": []}
        for k, gram in enumerate(grams):
            keys, at = np.unique(gram, return_inverse=True)
            counts = np.bincount(at, train, len(keys)).astype(np.int64)
            cut = _cuts(keys, parts[k])
            for p in range(parts[k]):
                a, b = cut[p], cut[p + 1]
                if b > a:
                    for name, x in zip(out, (k, p, key[0].as_py(), pack_keys(keys[a:b]), pack(counts[a:b]))):
                        out[name].append(x)
        return pa.table(out, pa.schema([("gram", pa.int32()), ("part", pa.int32()), ("block", pa.int32()),
                                        ("keys", pa.binary()), ("counts", pa.binary())]))
    return send


def _added(rows):
    """One model partition: its n-grams with their totals; what each block sent, and where it is among them."""
    import numpy as np

    sent = [unpack_keys(x) for x in rows["keys"].to_pylist()]
    counts = [unpack(x, len(s)) for x, s in zip(rows["counts"].to_pylist(), sent)]
    keys, at = np.unique(np.concatenate(sent), return_inverse=True)
    return keys, np.bincount(at, np.concatenate(counts), len(keys)).astype(np.int64), at, counts


def _total(key, rows):
    """One model partition: totals of its n-grams, told to each block that sent any."""
    import numpy as np

    _, totals, at, counts = _added(rows)
    # what other blocks add to a block's own count, mostly nothing
    answers = np.split(totals[at], np.cumsum([len(c) for c in counts])[:-1])
    return pa.table({"block": rows["block"], "gram": rows["gram"], "part": rows["part"],
                     "others": pa.array([pack(a - c) for a, c in zip(answers, counts)], pa.binary())})


def _sizes(key, rows):
    """One partition of words: its training tokens, distinct ones and ends of texts (of other n-grams no row)."""
    import numpy as np

    found: list = [[], [], []]
    if key[0].as_py() == 0:
        keys, totals, _, _ = _added(rows)
        found = [[int(totals.sum())], [int((totals > 0).sum())], [int(totals[keys == np.uint64(end_key())].sum())]]
    return pa.table(dict(zip(("tokens", "distinct", "ends"), (pa.array(x, pa.int64()) for x in found))))


class Automaton:
    """States, arcs and failure arcs that the n-grams of one block can reach.

    States are numbered: 0 has no context; then come, for k = 1 to order - 1,
    the context before a text's first token and the n-grams of k tokens.
    Arc number t is that of state 0 and token t; ``arcs`` maps state * words +
    token of the other states to the number of their arc.  An arc has a weight
    and the state that it leads to, ``fails`` has (weight, next shorter state)
    of each state."""

    def __init__(self, grams: list, counts: list, first, tokens: int, distinct: int, ends: int, mu: float):
        """``grams[k]``: at each position the number of its n-gram of k + 1
        tokens; ``counts[k]``: training counts of these n-grams."""
        import numpy as np

        order, begins = len(grams), first[:-1]
        self.words = len(counts[0])
        base = (counts[0] + 0.5) / (tokens + 0.5 * (distinct + 1))
        self.base_weight = np.log10(base)
        offset = np.cumsum([1] + [len(c) + 1 for c in counts[:-1]])  # of the states of k tokens, the text's begin first
        self.start = int(offset[order - 2]) if order > 1 else 0

        def state(k: int, gram):
            """The state after an n-gram of k tokens that training has (0: none)."""
            return np.where(counts[k - 1][gram] > 0, offset[k - 1] + 1 + gram, 0) if k else np.zeros(len(gram), np.int64)

        keys, weights, following = [np.zeros(0, np.int64)], [self.base_weight], [state(min(1, order - 1), np.arange(self.words))]
        fail_weight, fail_to, lower = [np.zeros(1)], [np.zeros(1, np.int64)], base
        for k in range(1, order):
            # of each n-gram of k + 1 tokens one place tells its context, its token and its suffix
            where = np.zeros(len(counts[k]), np.int64)
            where[grams[k]] = np.arange(len(grams[k]))
            opens = np.isin(where, begins)
            context = np.where(opens, -1, grams[k - 1][np.maximum(where - 1, 0)])
            suffix = grams[k - 1][where]
            seen = np.where(opens, ends, counts[k - 1][np.maximum(context, 0)])
            lower = (counts[k] + mu * lower[suffix]) / (seen + mu)
            held = np.flatnonzero(counts[k] > 0)
            keys.append((offset[k - 1] + 1 + context[held]) * self.words + grams[0][where[held]])
            weights.append(np.log10(lower[held]))
            following.append(state(k + 1, held) if k + 1 < order else state(k, suffix[held]))
            # failure arcs of the contexts of k tokens, to their suffixes of k - 1
            shorter = np.zeros(len(counts[k - 1]), np.int64)
            if k > 1:
                place = np.zeros(len(counts[k - 1]), np.int64)
                place[grams[k - 1]] = np.arange(len(grams[k - 1]))
                shorter = offset[k - 2] + 1 + grams[k - 2][place]
            have = np.concatenate([[ends], counts[k - 1]])
            fail_weight.append(np.log10(mu / (have + mu)))
            fail_to.append(np.concatenate([[offset[k - 2] if k > 1 else 0], shorter]))
        keys = np.concatenate(keys).tolist()
        self.arcs = dict(zip(keys, range(self.words, self.words + len(keys))))
        self.weights, self.following = np.concatenate(weights).tolist(), np.concatenate(following).tolist()
        self.fails = list(zip(np.concatenate(fail_weight).tolist(), np.concatenate(fail_to).tolist()))

    def traverse(self, tokens: list[int]) -> float:
        """log10 probability of a text, read from left to right."""
        arc_of, weights, following, fails, words = self.arcs.get, self.weights, self.following, self.fails, self.words
        state, total = self.start, 0.0
        for t in tokens:
            arc = arc_of(state * words + t) if state else t
            while arc is None:
                weight, state = fails[state]
                total += weight
                arc = arc_of(state * words + t) if state else t
            total += weights[arc]
            state = following[arc]
        return total


def _scorer(order: int, parts: list[int], mu: float, id_col: str, result: pa.Schema):
    def score(key, docs, answers):
        """One block: build its part of the automaton and traverse its texts."""
        import numpy as np

        if not docs.num_rows:  # a block that no text fell into
            return pa.table({f.name: pa.array([], f.type) for f in result})
        grams, _, first = grams_of(docs["text"].to_pylist(), order)
        train = np.repeat(np.asarray(docs["train"].to_pylist(), np.float64), np.diff(first))
        got = {(r["gram"], r["part"]): r for r in answers.to_pylist()}
        at, counts = [], []
        for k, gram in enumerate(grams):
            keys, inverse = np.unique(gram, return_inverse=True)
            cut = _cuts(keys, parts[k])
            own = np.bincount(inverse, train, len(keys)).astype(np.int64)
            counts.append(own + np.concatenate([unpack(got[k, p]["others"], cut[p + 1] - cut[p]) for p in range(parts[k])
                                                if cut[p + 1] > cut[p]]))
            at.append(inverse)
        tokens, distinct, ends = (got[None, None][x] for x in ("tokens", "distinct", "ends"))
        begins = first[:-1]
        machine = Automaton(at, counts, first, tokens, distinct, ends, mu)
        scores = [machine.traverse(at[0][a:b].tolist()) for a, b in zip(first[:-1], first[1:])]
        known = counts[0][at[0]] > 0
        return pa.table({
            id_col: docs[id_col], "train": docs["train"],
            "n_tokens": pa.array(np.diff(first), pa.int64()),
            "n_known": pa.array(np.add.reduceat(known.astype(np.int64), begins), pa.int64()),
            "train_tokens": pa.array(np.full(len(begins), tokens, np.int64), pa.int64()),
            "base_score": pa.array(np.add.reduceat(machine.base_weight[at[0]], begins), pa.float64()),
            "score": pa.array(scores, pa.float64())})
    return score


def _power(n: float) -> int:
    """The least power of two that is not below ``n``."""
    return 1 << max(0, int(-(-n // 1)) - 1).bit_length()


def score_documents(docs: DataFrame, train: Column, id_col: str = "doc_id", text: str = "text", order: int = ORDER,
                    mu: float = MU, block_bytes: int = BLOCK_BYTES, partition_keys: int = PARTITION_KEYS) -> DataFrame:
    """(id, train, n_tokens, n_known, train_tokens, base_score, score) of every
    row; ``train`` says which rows the model learns from."""
    spark = docs.sparkSession
    bounded_batches(spark)
    size = docs.agg(F.coalesce(F.sum(F.octet_length(text).cast("long")), F.lit(0))).head()[0]
    # small inputs go into more, smaller blocks, so that all cores have some
    blocks = max(1, -(-size // block_bytes), min(4 * spark.sparkContext.defaultParallelism, -(-size // (512 << 10))))
    keys = size / BYTES_A_TOKEN / partition_keys
    parts = [_power(keys / 4)] + [_power(keys)] * (order - 1)
    rows = docs.select(F.col(id_col), F.coalesce(F.col(text), F.lit("")).alias("text"),
                       F.coalesce(train, F.lit(False)).alias("train"))
    rows = rows.withColumn("block", F.pmod(F.xxhash64(id_col, "text"), F.lit(blocks)).cast("int"))
    sent = rows.groupBy("block").applyInArrow(_sender(order, parts), _SENT)
    messages = sent.groupBy("gram", "part")  # one exchange, read twice
    sizes = messages.applyInArrow(_sizes, _SIZES).agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c)
                                                        for c in ("tokens", "distinct", "ends")])
    sizes = sizes.select(F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"), "*")
    answers = messages.applyInArrow(_total, _ANSWER).unionByName(sizes, allowMissingColumns=True)
    result = rows.select(id_col, "train").schema
    for name in ("n_tokens", "n_known", "train_tokens"):
        result = result.add(name, "long")
    result = result.add("base_score", "double").add("score", "double")
    return rows.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(
        _scorer(order, parts, mu, id_col, to_arrow_schema(result)), result)
