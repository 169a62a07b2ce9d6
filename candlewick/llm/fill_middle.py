"""Fill-in-the-middle transformation on an indexable skip list.

A text is a row of units: code points, or what ``unit`` (a pattern) matches
from left to right, every code point outside a match being a unit of its own.
Two cut ranks, counted in units, divide it into prefix, middle and suffix.

The ranks are reached through an indexable skip list.  Its bottom lane is the
text itself; every ``FAN``-th node of a lane rises into the next express lane,
and each link of a lane carries its widths: how many units, code points and
bytes it passes over.  A descent starts at the top lane, walks forward while
the accumulated unit width does not pass the rank, and drops a lane; below the
lowest express lane it walks the units of one link.  The accumulated
code-point and byte widths are then the cut's exact offsets, so the pieces are
slices of the UTF-8 bytes.  The lanes are built while the text streams by in
pieces of ``PIECE`` bytes and hold less than half the text's bytes.

Draws: h1 to h4 are the first four 8-digit groups of the hex SHA-256 of
``seed``, a colon and the key, so a retry or another cluster cuts alike.
Prefix ends after the smaller of h1 % (n+1) and h2 % (n+1) units, middle after
the larger.  ``plain`` stays a text that is empty or holds a sentinel, and
where h3 % 100 >= ``rate``; of the others h4 % 100 < ``spm_rate`` gives the
order suffix-prefix-middle, the rest prefix-suffix-middle.  ``rebuilt`` takes
the pieces out of an output again; the sentinels can't arise across a joint,
which ``check_sentinels`` makes sure of.

Edge cases: a null text counts as the empty one, a null key as the empty key;
both stay in the result.  Texts of any length are cut whole.  Repeated rows
get equal results.  An empty table gives an empty result.  Other columns pass
through; a column named like the output is replaced.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from candlewick.llm.common import bounded_batches

SENTINELS = ("<P>", "<S>", "<M>")  # prefix, suffix, middle
SEED, RATE, SPM_RATE = "1", 90, 20
FAN = 64
PIECE = 1 << 18

_RESULT = pa.struct([("n", pa.int64()), ("form", pa.string()), ("prefix_chars", pa.int64()),
                     ("middle_chars", pa.int64()), ("output", pa.string())])
_RESULT_DDL = "struct<n: bigint, form: string, prefix_chars: bigint, middle_chars: bigint, output: string>"


class SkipList:
    """Express lanes over the units of ``raw`` (UTF-8).

    ``lanes[k]`` is an array [link, 3]: units, code points and bytes that each
    link of lane k passes over.  ``total`` has the sums.
    """

    def __init__(self, raw: bytes, unit: re.Pattern | None = None, fan: int = FAN, piece: int = PIECE):
        import numpy as np

        self.raw, self.unit, self.fan = raw, unit, fan
        lane, left = [], np.zeros((0, 3), np.int64)
        for nodes in self._units(piece):
            nodes = np.concatenate([left, nodes]) if len(left) else nodes
            whole = len(nodes) - len(nodes) % fan
            lane.append(self._links(nodes[:whole]))
            left = nodes[whole:]
        lane.append(self._links(left))
        self.lanes = [np.concatenate(lane)]
        while len(self.lanes[-1]) > fan:
            self.lanes.append(self._links(self.lanes[-1]))
        self.total = tuple(int(x) for x in self.lanes[-1].sum(axis=0))

    def _links(self, nodes):
        """Widths of the next lane's links over the nodes of one."""
        import numpy as np

        return np.add.reduceat(nodes, np.arange(0, len(nodes), self.fan), axis=0) if len(nodes) else nodes

    def _units(self, piece: int) -> Iterator:
        """Widths of the units, in runs of about ``piece`` bytes."""
        import numpy as np

        if self.unit is not None:
            run = []
            for width in self._matched(0):
                run.append(width)
                if len(run) >= piece >> 4:
                    yield np.array(run, np.int64)
                    run = []
            if run:
                yield np.array(run, np.int64)
            return
        data = np.frombuffer(self.raw, np.uint8)
        begin = 0
        while begin < len(data):
            end = min(len(data), begin + piece)
            while end < len(data) and data[end] & 0xC0 == 0x80:  # not inside a character
                end += 1
            at = np.flatnonzero(data[begin:end] & 0xC0 != 0x80)
            nodes = np.ones((len(at), 3), np.int64)
            nodes[:, 2] = np.diff(at, append=end - begin)
            yield nodes
            begin = end

    def _matched(self, begin: int) -> Iterator[tuple[int, int, int]]:
        """(1, code points, bytes) of the units from a byte offset that is a unit's start."""
        text, at = (self.raw[begin:] if begin else self.raw).decode(), 0
        for m in self.unit.finditer(text):
            if m.end() > m.start():
                for c in text[at:m.start()]:
                    yield 1, 1, len(c.encode())
                yield 1, m.end() - m.start(), len(m[0].encode())
                at = m.end()
        for c in text[at:]:
            yield 1, 1, len(c.encode())

    def descend(self, rank: int) -> tuple[int, int]:
        """(code points, bytes) of the first ``rank`` units."""
        import numpy as np

        if not 0 <= rank <= self.total[0]:
            raise IndexError(rank)
        passed, link = np.zeros(3, np.int64), 0
        for lane in reversed(self.lanes):
            part = np.cumsum(lane[link:link + self.fan], axis=0)
            n = int(np.searchsorted(passed[0] + part[:, 0], rank, side="right"))
            if n:
                passed = passed + part[n - 1]
            link = (link + n) * self.fan
        left = rank - int(passed[0])
        if left:  # the units of one link of the lowest express lane
            passed = passed + self._walk(int(passed[2]), left)
        return int(passed[1]), int(passed[2])

    def _walk(self, begin: int, units: int):
        import numpy as np

        if self.unit is not None:
            found = self._matched(begin)
            return np.array([next(found) for _ in range(units)], np.int64).sum(axis=0)
        data = np.frombuffer(self.raw, np.uint8, min(len(self.raw) - begin, 4 * units + 4), begin)
        starts = np.flatnonzero(data & 0xC0 != 0x80)
        end = int(starts[units]) if units < len(starts) else len(data)
        return np.array([units, units, end], np.int64)


def check_sentinels(marks: tuple[str, str, str]) -> None:
    """Sentinels must not overlap themselves or one another, else one could
    arise where a piece of text meets a sentinel."""
    if len(marks) != 3 or len(set(marks)) != 3 or not all(marks):
        raise ValueError("three different sentinels are needed")
    for a in marks:
        for b in marks:
            if (a != b and a in b) or any(a.endswith(b[:k]) for k in range(1, min(len(a), len(b)) + (a != b))):
                raise ValueError(f"the sentinels {a!r} and {b!r} overlap")


def transformed(text: str | None, h: tuple[int, int, int, int], marks: tuple[str, str, str] = SENTINELS,
                rate: int = RATE, spm_rate: int = SPM_RATE, unit: re.Pattern | None = None) -> dict:
    """The transformation of one text."""
    raw = (text or "").encode()
    units = SkipList(raw, unit)
    n = units.total[0]
    p, s, m = (x.encode() for x in marks)
    if not raw or p in raw or s in raw or m in raw or h[2] % 100 >= rate:
        return {"n": n, "form": "plain", "prefix_chars": None, "middle_chars": None, "output": raw.decode()}
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    (chars_a, a), (chars_b, b) = units.descend(a), units.descend(b)
    spm = h[3] % 100 < spm_rate
    parts = (s, raw[b:], p, raw[:a], m, raw[a:b]) if spm else (p, raw[:a], s, raw[b:], m, raw[a:b])
    return {"n": n, "form": "spm" if spm else "psm", "prefix_chars": chars_a, "middle_chars": chars_b - chars_a,
            "output": b"".join(parts).decode()}


def draws(key: Column, seed: str = SEED) -> list[Column]:
    """h1 to h4 of a key."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit("")))
    digits = F.sha2(text.cast("binary"), 256)
    return [F.conv(F.substring(digits, 8 * i + 1, 8), 16, 10).cast("long") for i in range(4)]


def fill_in_middle(df: DataFrame, key: str = "doc_id", text: str = "text", out: str = "fim", seed: str = SEED,
                   marks: tuple[str, str, str] = SENTINELS, rate: int = RATE, spm_rate: int = SPM_RATE,
                   unit: str | None = None) -> DataFrame:
    """Add struct column ``out``: n (units), form, prefix_chars, middle_chars
    (code points) and output."""
    check_sentinels(marks)
    bounded_batches(df.sparkSession)
    pattern = re.compile(unit) if unit else None

    @F.arrow_udf(_RESULT_DDL)
    def cut(it: Iterator[tuple[pa.Array, ...]]) -> Iterator[pa.Array]:
        for texts, *h in it:
            drawn = zip(*(x.to_pylist() for x in h))
            yield pa.array([transformed(t.as_py(), d, marks, rate, spm_rate, pattern) for t, d in zip(texts, drawn)],
                           _RESULT)

    return df.withColumn(out, cut(F.col(text), *draws(F.col(key), seed)))


def rebuilt(output: str, form: str, marks: tuple[str, str, str] = SENTINELS) -> str:
    """The text that an output of ``form`` was made of."""
    p, s, m = marks
    if form == "plain":
        return output
    first, second = (p, s) if form == "psm" else (s, p)
    a, rest = output[len(first):].split(second, 1)
    b, middle = rest.split(m, 1)
    return a + middle + b if form == "psm" else b + middle + a


def restore(df: DataFrame, output: Column, form: Column, out: str = "restored",
            marks: tuple[str, str, str] = SENTINELS) -> DataFrame:
    """Add column ``out``: the text rebuilt from an output and its form alone."""
    bounded_batches(df.sparkSession)

    @F.arrow_udf("string")
    def back(it: Iterator[tuple[pa.Array, ...]]) -> Iterator[pa.Array]:
        for outputs, forms in it:
            yield pa.array([None if o is None or f is None else rebuilt(o, f, marks)
                            for o, f in zip(outputs.to_pylist(), forms.to_pylist())], pa.string())

    return df.withColumn(out, back(output, form))
