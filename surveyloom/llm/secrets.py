"""Secret scans: fixed patterns, and tokens that pass a battery of randomness tests."""

from __future__ import annotations

import math
import re
import string
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from surveyloom.llm.frames import stored

#: Kinds in the order in which spans with the same start are listed.
KINDS = ("assign", "access", "hex", "random")
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ASSIGN_HINT = re.compile(r"passw|secret|token|api_?key")
ASSIGN_CHARS = 6
ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")
HEX = re.compile(r"[0-9a-f]{24,}")
#: A token that could be an encoding of random bytes: one digit at least, and LEAST_CHARS characters.
TOKEN = re.compile(r"(?<![A-Za-z0-9+/_-])(?=[A-Za-z+/_=-]*[0-9])[A-Za-z0-9+/_-]{16,}={0,2}(?![A-Za-z0-9+/_=-])")
DIGIT = re.compile(r"[0-9]")

UPPER, LOWER, DIGITS = string.ascii_uppercase, string.ascii_lowercase, string.digits
#: Alphabets in order of size; a token is taken for the first that has all its characters.
ENCODINGS = {
    "hex": DIGITS + "abcdef", "HEX": DIGITS + "ABCDEF", "base32": UPPER + "234567",
    "base36": DIGITS + LOWER, "BASE36": DIGITS + UPPER, "base62": DIGITS + UPPER + LOWER,
    "base64": UPPER + LOWER + DIGITS + "+/", "base64url": UPPER + LOWER + DIGITS + "-_",
}
BINS = 20
#: From 32 characters on, tokens are held against this many random ones for each bin and others in the first bin.
PRIOR_OCTAVE, EVEN, LOW = 6, 5, 6


def encoding_of(token: str) -> str | None:
    """The smallest alphabet that holds the token. Digits alone are numbers, and letters alone are words."""
    chars = set(token)
    if chars <= set(DIGITS) or not chars & set(DIGITS):
        return None
    return next((name for name, alphabet in ENCODINGS.items() if chars <= set(alphabet)), None)


def upper_tail(z: float) -> float:
    return 0.5 * math.erfc(z / math.sqrt(2))


def battery(token: str, alphabet: str) -> float:
    """p value of a token under "each character is drawn evenly and on its own from the alphabet".

    Fisher's sum of three: chi-squared of the character counts (its exact mean and variance at this length, with a
    cube-root normal tail), runs above and below the middle of the alphabet, and lag-1 serial correlation.
    """
    n, k = len(token), len(alphabet)
    x = np.array([alphabet.index(c) for c in token], float)
    counts = np.bincount(x.astype(int), minlength=k)
    chi = float((counts.astype(float) ** 2).sum()) * k / n - n
    mean, spread = k - 1.0, 2.0 * (k - 1) * (n - 1) / n
    scale, freedom = spread / (2 * mean), 2 * mean * mean / spread
    third = 2 / (9 * freedom)
    p_chi = upper_tail((max(chi, 0.0) / scale / freedom) ** (1 / 3) / math.sqrt(third) - (1 - third) / math.sqrt(third))
    high = x >= k / 2
    above, below = int(high.sum()), int((~high).sum())
    if above and below and n > 2:
        pairs = 2.0 * above * below
        expected, variance = pairs / n + 1, pairs * (pairs - n) / (n * n * (n - 1.0))
        runs = 1 + int((high[1:] != high[:-1]).sum())
        p_runs = 2 * upper_tail(abs(runs - expected) / math.sqrt(variance)) if variance > 0 else 1.0
    else:
        p_runs = 2.0 ** (1 - n)
    centred = x - x.mean()
    power = float((centred ** 2).sum())
    p_serial = 2 * upper_tail(abs(float((centred[1:] * centred[:-1]).sum()) / power + 1 / n) * math.sqrt(n)) if power else 0.0
    half = -sum(math.log(max(p, 1e-300)) for p in (p_chi, p_runs, min(p_serial, 1.0)))
    return min(1.0, math.exp(-half) * (1 + half + half * half / 2))


def scan(text: str) -> tuple[list[tuple[int, int, int]], list[tuple[int, int, str, float]]]:
    """Base spans (start, kind, end) in order, and other tokens (start, end, stratum, p value) outside of them."""
    base = []
    if ASSIGN_HINT.search(text.lower()):
        base += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= ASSIGN_CHARS]
    if "AKIA" in text:
        base += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text)]
    others = []
    if DIGIT.search(text):
        base += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
        base.sort()
        at, reach = 0, -1  # how far the base spans go that start before a token's end; tokens come in order
        for m in TOKEN.finditer(text):
            while at < len(base) and base[at][0] < m.end():
                at, reach = at + 1, max(reach, base[at][2])
            token = m[0].rstrip("=")
            if reach <= m.start() and (name := encoding_of(token)):
                octave = min(len(token).bit_length(), 12)
                others.append((m.start(), m.end(), f"{name}:{octave}", battery(token, ENCODINGS[name])))
    else:
        base += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(base), others


def scanned(docs: DataFrame) -> DataFrame:
    """doc_id, base spans and tested tokens of every whole text."""
    spans = pa.list_(pa.struct([("start", pa.int64()), ("kind", pa.int32()), ("end", pa.int64())]))
    tokens = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("stratum", pa.string()), ("p", pa.float64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            base, others = [], []
            for text in batch.column(1):
                found, tested = scan(text.as_py() or "")
                base.append([{"start": a, "kind": k, "end": b} for a, k, b in found])
                others.append([{"start": a, "end": b, "stratum": s, "p": p} for a, b, s, p in tested])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(base, spans), pa.array(others, tokens)],
                                             names=["doc_id", "base", "tokens"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        run, "doc_id long, base array<struct<start: long, kind: int, end: long>>, "
             "tokens array<struct<start: long, end: long, stratum: string, p: double>>")


def thresholds(histogram: dict[str, list[int]], rate: float) -> dict[str, float]:
    """The least p value at which the tokens of a stratum count as random, for a false-discovery rate.

    Random tokens have even p values, others pile up near 0. So tokens above a half, doubled, estimate the random
    ones, and of those at or above a cut the estimate says how many are not random. A stratum is an encoding and a
    length octave: short tokens, which tests tell apart badly, need a higher cut, long ones none. No cut, no entry.

    A few tokens say little about the noise among them. So a stratum of PRIOR_OCTAVE and up, where ordinary names mostly
    have p values below 1 / BINS, starts with EVEN random tokens for each bin and LOW others in the first: a lone key is
    found by its own p value, and some dozens of tokens outvote the start. Shorter tokens have no such start.
    """
    cuts = {}
    for stratum, found in histogram.items():
        octave = stratum.partition(":")[2]
        start = [EVEN + LOW] + [EVEN] * (BINS - 1) if octave and int(octave) >= PRIOR_OCTAVE else [0] * BINS
        counts = [a + b for a, b in zip(found, start)]
        even = 2 * sum(counts[BINS // 2:])
        for first in range(BINS):
            accepted = sum(counts[first:])
            if accepted and 1 - even * (1 - first / BINS) / accepted <= rate:
                cuts[stratum] = first / BINS
                break
    return cuts


def find_secrets(docs: DataFrame, rate: float = 0.05) -> DataFrame:
    """Secrets in every whole text: doc_id, spans (array of struct of start, rank, kind, end), in order.

    Kinds: assign, access and hex by pattern (code points, end exclusive), and random: a token outside the others that
    passes the battery at a cut which holds the false-discovery rate in its stratum. The cuts come from all documents: one
    histogram of p values per encoding and length octave, a table of bounded size whatever the corpus. Null texts are
    empty and have no spans; repeated rows are scanned each; null ids stay; an empty table gives no rows.
    """
    rows = stored(scanned(docs), "secret-scan")
    bins = rows.select(F.explode("tokens").alias("t")).groupBy(
        "t.stratum", F.least(F.floor(F.col("t.p") * BINS), F.lit(BINS - 1)).cast("int").alias("bin")).count()
    histogram: dict[str, list[int]] = {}
    for row in bins.collect():  # at most encodings x octaves x bins rows
        histogram.setdefault(row["stratum"], [0] * BINS)[row["bin"]] = row["count"]
    cuts = thresholds(histogram, rate)

    def cut_of(token):
        out = F.lit(2.0)
        for stratum, cut in cuts.items():
            out = F.when(token["stratum"] == stratum, F.lit(cut)).otherwise(out)
        return out

    names = F.array(*map(F.lit, KINDS))

    def span(start, rank, end):
        return F.struct(start.alias("start"), rank.cast("int").alias("rank"), F.get(names, rank).alias("kind"), end.alias("end"))

    base = F.transform("base", lambda s: span(s["start"], s["kind"], s["end"]))
    more = F.transform(F.filter("tokens", lambda t: t["p"] >= cut_of(t)),
                       lambda t: span(t["start"], F.lit(3), t["end"]))
    return rows.select("doc_id", F.array_sort(F.concat(base, more)).alias("spans"))
