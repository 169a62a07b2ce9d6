"""SentencePiece encoding and decoding on the tokenizers library.

The model protobuf is parsed on the driver and rebuilt as a tokenizers
pipeline: the normaliser (precompiled character map, extra white space, dummy
prefix, white space escaped to the metaspace marker), the model (unigram
scores, or for a BPE model the merges that its scores imply), byte fallback,
and the decoder, after which ``restored`` undoes marker and prefix on the whole
string (half the time of decoders that do it piece by piece).  Control pieces
are not matched in texts, as in the original library.

A BPE merge is every way to cut a normal piece into two normal pieces, tried
in the order of the whole piece's score.  Pieces of equal score (runs of white
space) prefer the longer left part, which is what leftmost-first merging does.

Workers get the parsed model by broadcast (a file of bounded size, checked)
and encode batches of at most ``BATCH_CHARS`` characters with the library's
threads.  Where a text can't be crossed by any piece (``cut_table``: between two
ASCII characters that no piece holds side by side, and before a run of
markers), it is cut, and the library encodes and decodes each distinct segment
once while it stays in the worker's dictionary of at most ``SEGMENTS`` segments
and ``SEGMENT_BYTES`` bytes.  A text's ids are its segments' ids in a row.  A
model with a marker behind another character in a piece has few such places;
its texts go to the library whole.

``parity`` encodes every whole text with the original library too and compares
all ids; ``round_trip`` compares the decoded text with the text as the
normaliser leaves it.

Edge cases: a null text has null ids and decodes to null; an empty text has no
ids.  Texts are never truncated.  An empty table gives an empty result.  Other
columns pass through; a column named like the output is replaced.  Models with
user-defined pieces or white space as suffix are refused with a ValueError.
"""

from __future__ import annotations

import os
import uuid
from collections.abc import Iterator
from itertools import chain

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from candlewick.llm.common import bounded_batches, worker_cache

BATCH_CHARS = 1 << 17        # of one call into the library: an encoding takes many times its text
MODEL_BYTES = 64 << 20       # largest model file that is broadcast
THREADS = 2                  # of the library in each worker
SEGMENTS = 1 << 18           # of a worker's dictionary
SEGMENT_BYTES = 16 << 20
CUT_CHARS = 1 << 20          # of texts that are cut at once: only their new segments go into the library

# Fixed values of the format.
NORMAL, UNKNOWN, CONTROL, USER_DEFINED, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
UNIGRAM, BPE = 1, 2
MARK = "▁"

_IDS = pa.list_(pa.int32())


def parse_model(raw: bytes) -> dict:
    """What the rebuild needs of a model protobuf, as plain values."""
    from sentencepiece import sentencepiece_model_pb2 as pb

    proto = pb.ModelProto()
    proto.ParseFromString(raw)
    kind, norm = proto.trainer_spec, proto.normalizer_spec
    pieces = [(p.piece, p.score, p.type) for p in proto.pieces]
    if kind.model_type not in (UNIGRAM, BPE):
        raise ValueError("only unigram and BPE models can be rebuilt")
    if kind.treat_whitespace_as_suffix or any(t == USER_DEFINED for *_, t in pieces):
        raise ValueError("white space as suffix and user-defined pieces are not supported")
    return {"raw": raw, "type": kind.model_type, "byte_fallback": kind.byte_fallback, "pieces": pieces,
            "unknown": next(i for i, (*_, t) in enumerate(pieces) if t == UNKNOWN),
            "charsmap": norm.precompiled_charsmap, "dummy_prefix": norm.add_dummy_prefix,
            "squeeze": norm.remove_extra_whitespaces, "escape": norm.escape_whitespaces}


def merges(pieces: list[tuple]) -> list[tuple[str, str]]:
    score = {p: s for p, s, t in pieces if t == NORMAL}
    cuts = ((-s, -i, len(p) - i, p[:i], p[i:]) for p, s in score.items() for i in range(1, len(p)))
    cuts = sorted(c for c in cuts if c[3] in score and c[4] in score)
    return [(a, b) for *_, a, b in cuts]


def rebuild(spec: dict):
    """The tokenizers pipeline of a parsed model."""
    from tokenizers import Regex, Tokenizer, decoders, models, normalizers

    pieces = spec["pieces"]
    if spec["type"] == UNIGRAM:
        # other than normal pieces never match a text; byte pieces come by fallback
        low = min((s for _, s, t in pieces if t == NORMAL), default=0.0)
        model = models.Unigram([(p, s if t == NORMAL else low - 1e4) for p, s, t in pieces], spec["unknown"],
                               spec["byte_fallback"])
    else:
        model = models.BPE({p: i for i, (p, *_) in enumerate(pieces)}, merges(pieces), fuse_unk=True,
                           byte_fallback=spec["byte_fallback"], unk_token=pieces[spec["unknown"]][0])
    tok, steps = Tokenizer(model), []
    if spec["charsmap"]:
        steps.append(normalizers.Precompiled(spec["charsmap"]))
    if spec["squeeze"]:
        steps += [normalizers.Replace(Regex("^ +| +$"), ""), normalizers.Replace(Regex(" {2,}"), " ")]
    if spec["dummy_prefix"]:
        steps.append(normalizers.Prepend(" "))
    if spec["escape"]:
        steps.append(normalizers.Replace(" ", MARK))
    tok.normalizer = normalizers.Sequence(steps)
    tok.decoder = decoders.Sequence([decoders.ByteFallback(), decoders.Fuse()])
    return tok


def restored(spec: dict, decoded: str) -> str:
    """A decoded string without marker and dummy prefix."""
    text = decoded.replace(MARK, " ") if spec["escape"] else decoded
    return text[1:] if spec["dummy_prefix"] and text.startswith(" ") else text


def plain(spec: dict, tok, text: str) -> str:
    """The text that decoding should give back: normalised, marker and dummy prefix undone."""
    if not spec["charsmap"] and not spec["squeeze"]:
        return text.replace(MARK, " ") if spec["escape"] else text
    return restored(spec, tok.normalizer.normalize_str(text))


def splits(spec: dict) -> bool:
    """Whether no piece can cross the start of a run of markers: the marker is a
    piece, and no piece has one behind another character."""
    normal = [p for p, _, t in spec["pieces"] if t == NORMAL]
    return spec["escape"] and MARK in normal and not any(MARK in p.lstrip(MARK) for p in normal)


def cut_table(spec: dict):
    """[byte, next byte]: whether a text may be cut between the two, markers
    being spaces.  One of the two is a piece of its own, so that runs of unknown
    characters, which may become one id, stay together."""
    import numpy as np

    normal = [p.replace(MARK, " ") for p, _, t in spec["pieces"] if t == NORMAL]
    pairs, alone = {p[i:i + 2] for p in normal for i in range(len(p) - 1)}, set(normal)
    cuts = np.zeros((256, 256), bool)
    for a in map(chr, range(128)):
        for b in map(chr, range(128)):
            cuts[ord(a), ord(b)] = a + b not in pairs and (a in alone or b in alone)
    cuts[128:, ord(" ")] = True
    return cuts.ravel()


class Segments:
    """Distinct segments of texts with their ids, for a model that ``splits``."""

    def __init__(self, spec: dict, tok, most: int = SEGMENTS, most_bytes: int = SEGMENT_BYTES):
        from tokenizers import Tokenizer

        self.spec, self.tok, self.most, self.most_bytes = spec, tok, most, most_bytes
        self.bare = Tokenizer(tok.model)  # takes normalised text
        self.bare.decoder = tok.decoder
        self.plain = not spec["charsmap"] and not spec["squeeze"]
        self.cuts = cut_table(spec)
        self.clear()

    def clear(self) -> None:
        import numpy as np

        self.known: dict[str, int] = {}
        self.bytes = 0
        # of each known segment: where its ids begin, how many, and whether they decode to it
        self.starts, self.sizes, self.same = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, bool)
        self.ids = np.zeros(0, np.int32)

    def normalised(self, text: str | None) -> bytes:
        """A text as the normaliser leaves it, but with spaces for markers."""
        if not text:
            return b""
        if not self.plain:
            return self.tok.normalizer.normalize_str(text).replace(MARK, " ").encode()
        return ((" " if self.spec["dummy_prefix"] else "") + text.replace(MARK, " ")).encode()

    def _learn(self, new: list[str]) -> None:
        import numpy as np

        marked = [x.replace(" ", MARK) for x in new]
        ids, back = [], []
        for i, j in _runs(marked, len):
            found = [e.ids for e in self.bare.encode_batch_fast(marked[i:j], add_special_tokens=False)]
            ids += found
            back += self.bare.decode_batch(found, skip_special_tokens=False)
        sizes = np.fromiter(map(len, ids), np.int64, len(ids))
        self.known.update(zip(new, range(len(self.known), len(self.known) + len(new))))
        self.bytes += sum(map(len, new))
        self.starts = np.concatenate([self.starts, len(self.ids) + np.cumsum(sizes) - sizes])
        self.sizes = np.concatenate([self.sizes, sizes])
        self.same = np.concatenate([self.same, [a == b for a, b in zip(marked, back)]])
        self.ids = np.concatenate([self.ids, np.fromiter(chain.from_iterable(ids), np.int32, int(sizes.sum()))])

    def encode(self, texts: list) -> tuple:
        """(all ids in a row, how many each text has, whether each decodes to its normalised text)."""
        import numpy as np

        data = [self.normalised(t) for t in texts]
        joined, ends = b"".join(data), np.cumsum([0, *map(len, data)])
        raw = np.frombuffer(joined, np.uint8)
        begins = np.zeros(len(raw) + 1, bool)
        if len(raw):
            begins[1:-1] = self.cuts[raw[:-1].astype(np.uint16) << 8 | raw[1:]]
        begins[ends] = True
        at = np.flatnonzero(begins)
        segments = pa.StringArray.from_buffers(len(at) - 1, pa.py_buffer(at.astype(np.int32)), pa.py_buffer(joined))
        coded = segments.dictionary_encode()
        distinct = coded.dictionary.to_pylist()
        new = [x for x in distinct if x not in self.known]
        if new:
            self._learn(new)
        number = np.fromiter(map(self.known.__getitem__, distinct), np.int64, len(distinct))[np.asarray(coded.indices)]
        sizes = self.sizes[number]
        done = np.concatenate([[0], np.cumsum(sizes)])
        ids = self.ids[np.repeat(self.starts[number] - done[:-1], sizes) + np.arange(done[-1])]
        broken = np.concatenate([[0], np.cumsum(~self.same[number])])
        edge = np.searchsorted(at, ends)  # the texts' first segments
        if len(self.known) > self.most or self.bytes > self.most_bytes:
            self.clear()
        return ids, np.diff(done[edge]), np.diff(broken[edge]) == 0


def _runs(texts: list, size, most: int = BATCH_CHARS) -> Iterator[tuple[int, int]]:
    """Ranges of ``texts`` of about a batch's size."""
    i = 0
    while i < len(texts):
        j, n = i, 0
        while j < len(texts) and (j == i or n + size(texts[j]) <= most):
            n += size(texts[j])
            j += 1
        yield i, j
        i = j


class _Codec:
    """A model as executors use it, loaded once in a worker."""

    def __init__(self, df: DataFrame, model_file: str, threads: int):
        if os.path.getsize(model_file) > MODEL_BYTES:
            raise ValueError(f"{model_file} is larger than {MODEL_BYTES} bytes")
        bounded_batches(df.sparkSession)
        with open(model_file, "rb") as f:
            spec = parse_model(f.read())
        self.shared, self.name, self.threads = df.sparkSession.sparkContext.broadcast(spec), uuid.uuid4().hex, threads

    def load(self):
        store = worker_cache()
        if ("sentencepiece", self.name) not in store:
            os.environ["TOKENIZERS_PARALLELISM"] = "true" if self.threads > 1 else "false"
            os.environ["RAYON_NUM_THREADS"] = str(self.threads)
            import sentencepiece

            store.clear()
            spec = self.shared.value
            tok = rebuild(spec)
            store["sentencepiece", self.name] = spec, tok, Segments(spec, tok) if splits(spec) else None, (
                sentencepiece.SentencePieceProcessor(model_proto=spec["raw"]))
        return store["sentencepiece", self.name]


def _encoded(tok, segments: Segments | None, texts: list) -> tuple:
    """(all ids in a row, how many each text has, whether each decodes to its
    normalised text, or None where that is not known) of a batch."""
    if segments:
        return segments.encode(texts)
    ids = [e.ids if t else [] for t, e in zip(texts, tok.encode_batch_fast([t or "" for t in texts],
                                                                           add_special_tokens=False))]
    return *_flat(ids), None


def _flat(ids: list) -> tuple:
    import numpy as np

    sizes = np.fromiter(map(len, ids), np.int64, len(ids))
    return np.fromiter(chain.from_iterable(ids), np.int32, int(sizes.sum())), sizes


def _listed(ids, sizes, texts: list) -> pa.ListArray:
    """The ids as a list column, null where the text is."""
    import numpy as np

    at = pa.array(np.concatenate([[0], np.cumsum(sizes)]), pa.int32())
    return pa.ListArray.from_arrays(at, pa.array(ids, pa.int32()), mask=pa.array([t is None for t in texts], pa.bool_()))


def _decode(spec: dict, tok, ids: list) -> list:
    out = []
    for i, j in _runs(ids, lambda x: 4 * len(x or ())):
        text = tok.decode_batch([x or [] for x in ids[i:j]], skip_special_tokens=False)
        out += [None if x is None else restored(spec, t) for x, t in zip(ids[i:j], text)]
    return out


def encode(df: DataFrame, model_file: str, text: str = "text", out: str = "ids", threads: int = THREADS) -> DataFrame:
    """Add column ``out``: the ids of ``text``."""
    codec = _Codec(df, model_file, threads)

    @F.arrow_udf("array<int>")
    def encoded(it: Iterator[pa.Array]) -> Iterator[pa.Array]:
        _, tok, segments, _ = codec.load()
        for batch in it:
            texts = batch.to_pylist()
            parts = [_listed(*_encoded(tok, segments, texts[i:j])[:2], texts[i:j])
                     for i, j in _runs(texts, lambda t: len(t or ""), CUT_CHARS if segments else BATCH_CHARS)]
            yield pa.concat_arrays(parts) if parts else pa.array([], _IDS)

    return df.withColumn(out, encoded(F.col(text)))


def decode(df: DataFrame, model_file: str, ids: str = "ids", out: str = "decoded", threads: int = THREADS) -> DataFrame:
    """Add column ``out``: the text of ``ids``."""
    codec = _Codec(df, model_file, threads)

    @F.arrow_udf("string")
    def decoded(it: Iterator[pa.Array]) -> Iterator[pa.Array]:
        spec, tok, *_ = codec.load()
        for ids in it:
            yield pa.array(_decode(spec, tok, ids.to_pylist()), pa.string())

    return df.withColumn(out, decoded(F.col(ids)))


def _equal(ids, sizes, other_ids, other_sizes) -> list[bool]:
    """Text by text, whether two codings agree."""
    import numpy as np

    if np.array_equal(sizes, other_sizes) and np.array_equal(ids, other_ids):
        return [True] * len(sizes)
    a, b = np.cumsum(sizes), np.cumsum(other_sizes)
    return [np.array_equal(ids[i - n:i], other_ids[j - m:j]) for i, n, j, m in zip(a, sizes, b, other_sizes)]


_CHECKED = pa.struct([("ids", _IDS), ("round_trip", pa.bool_()), ("parity", pa.bool_())])


def encode_checked(df: DataFrame, model_file: str, text: str = "text", out: str = "encoded",
                   threads: int = THREADS) -> DataFrame:
    """Add struct column ``out``: ids, round_trip (they decode to the
    normalised text) and parity (the original library gives the same ids)."""
    codec = _Codec(df, model_file, threads)

    @F.arrow_udf("struct<ids: array<int>, round_trip: boolean, parity: boolean>")
    def checked(it: Iterator[pa.Array]) -> Iterator[pa.Array]:
        import numpy as np

        spec, tok, segments, original = codec.load()
        for batch in it:
            texts = batch.to_pylist()
            ids, same, back = [], [], []
            for i, j in _runs(texts, lambda t: len(t or ""), CUT_CHARS if segments else BATCH_CHARS):
                part = texts[i:j]
                flat, sizes, whole = _encoded(tok, segments, part)
                known = original.encode([t or "" for t in part], num_threads=codec.threads)
                if whole is None:
                    got = [x.tolist() for x in np.split(flat, np.cumsum(sizes)[:-1])]
                    whole = [a == plain(spec, tok, t or "") for t, a in zip(part, _decode(spec, tok, got))]
                ids.append(_listed(flat, sizes, part))
                back += [None if t is None else bool(x) for t, x in zip(part, whole)]
                same += [None if t is None else x for t, x in zip(part, _equal(flat, sizes, *_flat(known)))]
            yield pa.StructArray.from_arrays(
                [pa.concat_arrays(ids) if ids else pa.array([], _IDS), pa.array(back, pa.bool_()),
                 pa.array(same, pa.bool_())], fields=list(_CHECKED))

    return df.withColumn(out, checked(F.col(text)))


def n_tokens(ids: Column) -> Column:
    return F.coalesce(F.size(ids), F.lit(0)).cast("long")
