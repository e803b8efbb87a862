"""Benchmark decontamination by greedy string tiling with running Karp-Rabin."""

from __future__ import annotations

import heapq
import re
from collections import defaultdict
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strandline.llm.common import lean

WORD = re.compile(r"\w+")
#: Modulus and base of the running hash.
PRIME, BASE = (1 << 61) - 1, 1_000_003
#: UTF-8 bytes of benchmark text that a task holds at once; a larger benchmark is taken in several passes over the documents.
BLOCK_BYTES = 4 << 20


def running_hashes(tokens: list[int], width: int) -> Iterator[int]:
    """The hash of every window of width tokens, each from the one before."""
    if len(tokens) < width:
        return
    top = pow(BASE, width - 1, PRIME)
    h = 0
    for t in tokens[:width]:
        h = (h * BASE + t) % PRIME
    yield h
    for gone, come in zip(tokens, tokens[width:], strict=False):
        h = ((h - gone * top) * BASE + come) % PRIME
        yield h


def tiles(pattern: list[int], text: list[int], least: int, first: int = 20) -> list[tuple[int, int, int]]:
    """Tiles (start in pattern, start in text, length) of at least ``least`` tokens, none overlapping in either string.

    From long search lengths to short: windows of unmarked tokens meet by their running hash, are extended token by token, and
    the longest matches are marked first, of equal ones the first in the pattern, then in the text. What a marked tile leaves
    free of another match is a match of its own, so no match of ``least`` unmarked tokens is left. A match over twice the search length restarts the search with its own length.
    """
    free_p, free_t = bytearray(b"\1" * len(pattern)), bytearray(b"\1" * len(text))
    found: list[tuple[int, int, int]] = []
    width = max(least, min(first, len(pattern)))
    while True:
        windows = defaultdict(list)
        for i, h in enumerate(running_hashes(pattern, width)):
            if free_p.find(0, i, i + width) < 0:
                windows[h].append(i)
        matches: list[tuple[int, int, int]] = []
        longer = 0
        for j, h in enumerate(running_hashes(text, width)):
            if h in windows and free_t.find(0, j, j + width) < 0:
                for i in windows[h]:
                    if i and j and pattern[i - 1] == text[j - 1] and free_p[i - 1] and free_t[j - 1]:
                        continue  # inside a match that begins before it
                    n = 0
                    while i + n < len(pattern) and j + n < len(text) and pattern[i + n] == text[j + n] and free_p[i + n] and free_t[j + n]:
                        n += 1
                    if n > 2 * width:
                        longer = max(longer, n)
                    if n >= width:
                        matches.append((-n, i, j))
        if longer:
            width = longer
            continue
        heapq.heapify(matches)
        while matches:
            n, i, j = heapq.heappop(matches)
            n = -n
            free = bytes(a & b for a, b in zip(free_p[i : i + n], free_t[j : j + n], strict=True))
            if 0 not in free:
                free_p[i : i + n] = free_t[j : j + n] = bytes(n)
                found.append((i, j, n))
                continue
            for piece in re.finditer(b"\1{%d,}" % width, free):  # what longer tiles have left of it waits for its turn
                heapq.heappush(matches, (piece.start() - piece.end(), i + piece.start(), j + piece.start()))
        if width == least:
            return found
        width = max(least, width // 2)


class Benchmark:
    """Items as token lists, and the places of their seeds: runs of ``seed`` tokens, or all tokens of a shorter item."""

    def __init__(self, items: list[tuple[int, str]], seed: int) -> None:
        self.codes: dict[str, int] = {}
        self.items: dict[int, list[int]] = {}
        self.seeds: dict[int, dict[tuple[str, ...], list[int]]] = defaultdict(dict)
        for n, (_, text) in enumerate(items):
            words = WORD.findall(text.lower())
            if words:
                self.items[n] = [self.codes.setdefault(w, len(self.codes) + 1) for w in words]
                k = min(seed, len(words))
                for i in range(len(words) - k + 1):
                    held = self.seeds[k].setdefault(tuple(words[i : i + k]), [])
                    if not held or held[-1] != n:
                        held.append(n)

    def shared(self, words: list[str]) -> dict[int, list[tuple[int, int]]]:
        """For each item the runs [from, to) of words that its seeds cover."""
        runs: dict[int, list[tuple[int, int]]] = defaultdict(list)
        for k, seeds in self.seeds.items():
            for j, gram in enumerate(zip(*(words[i:] for i in range(k)), strict=False)):
                if gram in seeds:
                    for n in seeds[gram]:
                        own = runs[n]
                        if own and own[-1][1] >= j:
                            own[-1] = (own[-1][0], j + k)
                        else:
                            own.append((j, j + k))
        return runs

    def matches(self, text: str, seed: int, coverage: float) -> list[tuple[int, float, int, int]]:
        """(item's place, coverage, matched tokens, tiles) of the items that the text covers enough."""
        words = WORD.findall(text.lower())
        out = []
        for n, runs in self.shared(words).items():
            item = self.items[n]
            least = min(seed, len(item))
            if sum(b - a for a, b in runs) < coverage * len(item):
                continue
            own: list[int] = []
            for a, b in runs:
                own += [self.codes.get(w, 0) for w in words[a:b]]
                own.append(-1 - len(own))  # unlike any token: no tile goes over it
            found = tiles(item, own, least)
            matched = sum(x[2] for x in found)
            if matched >= coverage * len(item):
                out.append((n, matched / len(item), matched, len(found)))
        return out


SCHEMA = "doc_id long, item_id long, coverage double, matched long, tiles long"


def contamination(docs: DataFrame, benchmark: DataFrame, seed: int = 5, coverage: float = 0.5) -> DataFrame:
    """(doc_id, item_id, coverage, matched, tiles): every document and benchmark item of which it holds enough.

    Tokens are runs of letters, digits and underscores in lower case. Pairs meet by a run of ``seed`` equal tokens. Within a
    pair, tiles of at least ``seed`` tokens are placed greedily, the longest first, and the coverage is the share of the
    item's tokens that they mark; so a passage is found whole, cut up or with its parts in another order. Pairs with a
    coverage of at least ``coverage`` are returned.

    Null, empty and tokenless texts and items match nothing. Items with fewer tokens than a seed match as a whole. Equal rows
    give equal rows, equal items one row each; other columns are ignored. Whole texts are read where they are; no row is shuffled. The benchmark goes to
    the tasks in blocks of at most BLOCK_BYTES (or one item, if that is larger), one pass over the documents each, so its
    size has no bound that memory sets.
    """
    out = None
    for items in _blocks(benchmark):
        held = docs.sparkSession.sparkContext.broadcast(items)

        def run(batches: Iterator[pa.RecordBatch], held=held) -> Iterator[pa.RecordBatch]:
            block = Benchmark(held.value, seed)
            for batch in batches:
                rows = []
                for i, text in enumerate(batch.column(1)):
                    rows += [(i, held.value[n][0], *rest) for n, *rest in block.matches(text.as_py() or "", seed, coverage)]
                columns = [batch.column(0).take(pa.array([r[0] for r in rows], pa.int64()))]
                columns += [pa.array([r[k] for r in rows], t) for k, t in ((1, pa.int64()), (2, pa.float64()), (3, pa.int64()), (4, pa.int64()))]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "item_id", "coverage", "matched", "tiles"])

        found = docs.select("doc_id", "text").mapInArrow(lean(run), SCHEMA)
        out = found if out is None else out.unionAll(found)
    return out


def _blocks(benchmark: DataFrame) -> Iterator[list[tuple[int, str]]]:
    """The benchmark's items in blocks of about BLOCK_BYTES; one empty block for an empty benchmark."""
    items = benchmark.where("text is not null and length(text) > 0").select("item_id", "text")
    total = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = total // (BLOCK_BYTES // 2) + 1
    of = F.pmod(F.xxhash64("item_id", "text"), F.lit(n))
    for k in range(n):
        yield [tuple(r) for r in items.where(of == k).orderBy("item_id", "text").collect()]


def decontaminated(docs: DataFrame, benchmark: DataFrame, seed: int = 5, coverage: float = 0.5) -> DataFrame:
    """The rows of docs that hold no benchmark item, with all their columns: one pass, or one a block, and no shuffle."""
    at = docs.columns.index("text")
    for items in _blocks(benchmark):
        held = docs.sparkSession.sparkContext.broadcast(items)

        def clean(batches: Iterator[pa.RecordBatch], held=held) -> Iterator[pa.RecordBatch]:
            block = Benchmark(held.value, seed)
            for batch in batches:
                yield batch.filter(pa.array([not block.matches(x.as_py() or "", seed, coverage) for x in batch.column(at)], pa.bool_()))

        docs = docs.mapInArrow(lean(clean), docs.schema)
    return docs
