"""Periodic runs of words: seeds on diagonals, extended once.

A run of smallest period q has q words apart equal over 3 q words at least, so for the lags of one
class (1, 2, 3-4, 5-8, ...) some length of k-grams fits into every such overlap. All k-grams of a text are
indexed by exact ranks, which double in length; a k-gram and its next occurrence are a seed if their
distance is a lag of the class. Next occurrences are enough: k >= q, so a nearer one inside a run
would give the run a smaller period. Seeds are extended along their diagonal, and a
table of the furthest covered place of each lag leaves out seeds that an extension has passed
already. All work on one text stays in its task, linear in its words for each class.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import bounded_batches, byte_slices, release

#: A run has so many periods, and so many words, at least.
PERIODS, WORDS = 4, 6


def split_words(raw: bytes | None) -> list[bytes]:
    """Words of a text in UTF-8: runs of bytes other than space and the control signs 9 to 13."""
    return raw.split() if raw else []


def planted(n: int, key: int | None) -> np.ndarray | None:
    """Places of the original words after planting a period by the key's crc32; None without one."""
    h = zlib.crc32(str(key).encode()) if key is not None else 1
    if h % 10 or not n:
        return None
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    at = np.arange(n)
    at[a:] = a + (at[a:] - a) % p
    return at


def seeds(codes: np.ndarray, least: int = WORDS, periods: int = PERIODS) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(places, lags) by class of lags. Texts are told apart by ``codes``: no code stands in two texts.

    A rank is -1 where a k-gram occurs once only; ranks double until no k-gram occurs twice.
    """
    rank, size, top = _repeated(codes.astype(np.int64)), 1, 1
    ranks = {1: rank}
    while (low := top // 2 + 1) * periods <= len(codes):  # lags low..top
        k = max((periods - 1) * low, least - top)  # the overlap that any run of such a lag has
        while 2 * size <= k:
            rank = ranks[size]
            ranks = {2 * size: _paired(rank, size, rank)}
            size *= 2
        rank = ranks[size]
        if k > size:
            rank = _paired(rank, k - size, rank)
        at = np.flatnonzero(rank >= 0)
        if not (ranks[size] >= 0).any():
            return
        order = at[np.argsort(rank[at], kind="stable")]
        lag = order[1:] - order[:-1]
        good = (rank[order[1:]] == rank[order[:-1]]) & (lag >= low) & (lag <= top)
        yield order[:-1][good], lag[good]
        top *= 2


def _repeated(values: np.ndarray) -> np.ndarray:
    """Numbers of equal values, -1 for values that occur once."""
    rank, distinct = pd.factorize(values)
    rank = rank.astype(np.int64)
    rank[np.bincount(rank, minlength=len(distinct))[rank] < 2] = -1
    return rank


def _paired(left: np.ndarray, shift: int, right: np.ndarray) -> np.ndarray:
    """Ranks of the pairs (left[i], right[i + shift])."""
    out = np.full(len(left), -1, np.int64)
    n = len(left) - shift
    if n > 0:
        at = np.flatnonzero((left[:n] >= 0) & (right[shift:] >= 0))
        out[at] = _repeated(left[at] * (int(right.max(initial=0)) + 1) + right[at + shift])
    return out


def _equal_from(codes: np.ndarray, i: int, lag: int, stop: int, step: int) -> int:
    """How far from ``i`` (towards ``stop``, by growing slices) the words equal those ``lag`` further."""
    size = 64
    while i != stop:
        n = min(size, abs(stop - i))
        part = slice(i, i + n) if step > 0 else slice(i - n, i)
        differ = np.flatnonzero(codes[part] != codes[part.start + lag : part.stop + lag])
        if len(differ):
            return i + int(differ[0]) if step > 0 else i - n + int(differ[-1]) + 1
        i, size = i + step * n, size * 2
    return i


def periodic_runs(codes: np.ndarray, starts: np.ndarray, least: int = WORDS, periods: int = PERIODS) -> list[tuple[int, int, int]]:
    """(start, length, period) of all runs, by start and period, of texts that begin at ``starts``.

    A run is a stretch of words with smallest period q, no neighbouring word extends it, and it has
    ``least`` words and ``periods`` * q words or more. Places count over all texts.
    """
    bounds, out = np.append(starts, len(codes)), []
    for places, lags in seeds(codes, least, periods):
        order = np.lexsort((places, lags))
        places, lags = places[order], lags[order]
        # a seed right after another of its lag lies in what that one covers
        head = np.ones(len(places), bool)
        head[1:] = (lags[1:] != lags[:-1]) | (places[1:] != places[:-1] + 1)
        covered: dict[int, int] = {}
        text = np.searchsorted(bounds, places[head], side="right")
        for i, lag, t in zip(places[head].tolist(), lags[head].tolist(), text.tolist(), strict=True):
            if i < covered.get(lag, 0):
                continue
            end = _equal_from(codes, i, lag, int(bounds[t]) - lag, 1)
            start = _equal_from(codes, i, lag, int(bounds[t - 1]), -1)
            covered[lag] = end
            if (length := end + lag - start) >= max(least, periods * lag):
                out.append((start, length, lag))
    return sorted(out, key=lambda r: (r[0], r[2]))


SCHEMA = ("doc_id long, n_runs long, start long, length long, period long, exponent_milli long, runs_sha256 string, "
          "collapsed_sha256 string, n_words long, collapsed string")


def _sha(raw: bytes) -> str:
    return hashlib.sha256(raw).hexdigest()


def _texts(keys: list, raws: list[bytes | None], plant: bool) -> list[tuple]:
    """A row of SCHEMA for each text; all texts together are searched for runs at once."""
    texts, parts, seen, base = [], [], [], 0
    for key, raw in zip(keys, raws, strict=True):
        words, known = split_words(raw), {}
        if plant and (at := planted(len(words), key)) is not None:
            words = [words[i] for i in at.tolist()]
        codes = np.fromiter((known.setdefault(w, len(known)) for w in words), np.int64, len(words)) + base
        base += len(known)
        texts.append(words)
        parts.append(codes)
        seen.append(len(words))
    starts = np.cumsum([0, *seen[:-1]])
    runs = periodic_runs(np.concatenate(parts) if parts else np.zeros(0, np.int64), starts)
    of = np.searchsorted(np.append(starts, sum(seen)), [r[0] for r in runs], side="right") - 1
    cut = np.searchsorted(of, np.arange(len(texts) + 1))
    rows = []
    for t, (key, words) in enumerate(zip(keys, texts, strict=True)):
        own = [(s - int(starts[t]), n, q) for s, n, q in runs[cut[t] : cut[t + 1]]]
        kept = words
        if own:
            gone = np.zeros(len(words) + 1, np.int64)
            for s, n, q in own:
                gone[s + q] += 1
                gone[s + n] -= 1
            kept = [words[i] for i in np.flatnonzero(np.cumsum(gone[:-1]) == 0).tolist()]
        best = min(own, key=lambda r: (-r[1], r[0], r[2]), default=(None, None, None))
        text = b" ".join(kept)
        rows.append((key, len(own), *best, 1000 * best[1] // best[2] if own else None, _sha(b"".join(b"%d,%d,%d\n" % r for r in own)), _sha(text), len(words), text.decode("utf-8", "replace")))
    return rows


def collapse_runs(docs: DataFrame, plant: bool = False, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """For each row its runs' number, longest run and digest, and the text with each run cut to one period.

    Runs are stretches of words with a smallest period q of 6 words and 4 * q words or more. The longest one is
    the first of equal length, with the smaller period. Words of a run after its first q words go;
    ``collapsed`` holds the others joined by single spaces, ``collapsed_sha256`` its digest. Without
    a run start, length, period and exponent_milli are NULL. NULL and empty texts have no word and
    no run. Rows with equal keys are treated alike, each for itself; NULL keys stay. Texts of any
    length are searched whole. Other columns are ignored; an empty table gives no rows.

    With ``plant``, texts whose key's crc32 says so are made periodic first (for checks); a NULL key never.
    """
    bounded_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, raws = batch.column(0).to_pylist(), batch.column(1)
            sizes = np.array([len(x.as_buffer()) if x.is_valid else 0 for x in raws], np.int64)
            for a, b in byte_slices(sizes, 1 << 20):
                rows = _texts(keys[a:b], raws.slice(a, b - a).to_pylist(), plant)
                kinds = [pa.int64()] * 6 + [pa.string()] * 2 + [pa.int64(), pa.string()]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names=[f.split()[0] for f in SCHEMA.split(", ")])
        release()

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").cast("binary").alias("raw")).mapInArrow(run, SCHEMA)
