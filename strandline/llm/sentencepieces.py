"""SentencePiece encoding and decoding as a max-plus scan.

A text is a lattice of pieces. An encoding is the best path through it, where a step from one piece to the next weighs

* for a unigram model, the score of the next piece;
* for a BPE model, 0 if the two pieces would stand next to each other in an encoding of their own, minus infinity if not.
  Every text has exactly one path of weight 0, and it is what merging by rank gives.

Giant texts are cut at any place. The state at a cut is the piece that covers the character before it. Each chunk yields the
max-plus matrix from states at its left cut to states at its right cut. The product of matrices is associative, so runs of FAN
neighbours are multiplied at a time, all runs at once, level by level; going back down, each run finds the states at its inner
cuts between the two that it was given, and each chunk is then traced back by itself. No task ever has a whole text's matrices.
"""

from __future__ import annotations

import array
import functools
import hashlib
import itertools
import re
from collections.abc import Callable, Iterator
from typing import NamedTuple

import ahocorasick
import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strandline.llm.common import groups, lean, written

SPACE = "▁"
#: Texts of more characters than this are cut in chunks of so many.
CHUNK = 16_384
#: Matrices that are multiplied at a time.
FAN = 16
#: Stretches whose pieces a worker holds, and as many older ones.
HELD = 250_000
#: Pairs of pieces of which a task knows whether they fit.
LINKS = 400_000
NEVER = float("-inf")


class Spec(NamedTuple):
    """What the executors need of a model file."""

    kind: str  # "bpe" or "unigram"
    ids: dict[str, int]
    rank: dict[int, float]  # BPE: earlier merges are lower; characters are -1. Unigram: minus the score
    parts: dict[int, tuple[int, int]]  # BPE: the two pieces of the last merge that made a piece
    byte_ids: list[int]
    unk: int
    longest: int
    cut: str  # a pattern of the stretches that no piece goes beyond


def field(data: bytes, want: int) -> Iterator[bytes | int]:
    """Values of a field of a serialized message."""

    def number(at: int) -> tuple[int, int]:
        value = shift = 0
        while True:
            value |= (data[at] & 127) << shift
            shift += 7
            at += 1
            if data[at - 1] < 128:
                return value, at

    at = 0
    while at < len(data):
        key, at = number(at)
        kind = key & 7
        if kind == 0:
            value, at = number(at)
        else:
            size = {1: 8, 5: 4}.get(kind)
            if kind == 2:
                size, at = number(at)
            value, at = data[at : at + size], at + size
        if key >> 3 == want:
            yield value


def merged(chars: list[str], ids: dict[str, int], rank: dict[int, float]) -> tuple[list[str], tuple[str, str] | None]:
    """Pieces of a string by merging the pair of the lowest rank again and again, the leftmost of equals; and the last merge."""
    parts, last = list(chars), None
    while True:
        best = min(((rank[ids[a + b]], i) for i, (a, b) in enumerate(zip(parts, parts[1:], strict=False)) if a + b in ids), default=None)
        if best is None:
            return parts, last
        i = best[1]
        last = (parts[i], parts[i + 1])
        parts[i : i + 2] = ["".join(last)]


def load(model: bytes) -> Spec:
    """A model's pieces, from the bytes of its file. Only models whose normalizer leaves the text as it is are taken."""
    sp = sentencepiece.SentencePieceProcessor(model_proto=model)
    trainer, normalizer = next(field(model, 2)), next(field(model, 3))
    kind = {1: "unigram", 2: "bpe"}.get(next(field(trainer, 3), 1))
    if kind is None or next(field(normalizer, 1), b"") != b"identity" or next(field(normalizer, 4), 1):
        raise ValueError("only unigram and BPE models with the identity normalizer and white space kept are supported")
    plain = [i for i in range(len(sp)) if not (sp.is_byte(i) or sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i))]
    ids = {sp.id_to_piece(i): i for i in plain}
    rank = {i: -1.0 if kind == "bpe" and len(sp.id_to_piece(i)) == 1 else -sp.get_score(i) for i in plain}
    parts: dict[int, tuple[int, int]] = {}
    if kind == "bpe":
        for piece, i in list(ids.items()):
            if len(piece) > 1:
                made, last = merged(list(piece), ids, rank)
                if made == [piece]:
                    parts[i] = (ids[last[0]], ids[last[1]])
    byte_ids = [sp.piece_to_id(f"<0x{b:02X}>") for b in range(256)]
    if not all(sp.is_byte(i) for i in byte_ids):
        byte_ids = []
    inside = {c for piece in ids if len(piece) > 1 for c in piece}
    alone = {c for c in map(chr, range(128)) if c not in inside}
    if any(SPACE in piece.lstrip(SPACE) for piece in ids):
        cut = r"(?s:.+)"
    else:
        # signs that no piece has after a letter (or any other character that is no ASCII sign): a stretch ends before them
        signs = {c for c in map(chr, range(33, 127)) if not c.isalnum()} - alone
        after = {b for piece in ids for a, b in itertools.pairwise(piece) if a not in signs and a != SPACE}
        a, s, q = (re.escape("".join(sorted(x))) for x in (alone, signs, signs & after))
        more = f"(?:[{q}][{s}]*[^{SPACE}{a}{s}]*)*" if q else ""
        cut = f"(?:{SPACE}+[{s}]*|[{s}]+)[^{SPACE}{a}{s}]*{more}|[^{SPACE}{a}{s}]+{more}|[{a}]" if s else f"{SPACE}+[^{SPACE}{a}]*|[^{SPACE}{a}]+|[{a}]"
    return Spec(kind, ids, rank, parts, byte_ids, sp.unk_id(), max(map(len, ids)), cut)


class Arc(NamedTuple):
    """A piece in a text: where it ends, its length, and its id (-1: a character that is no piece)."""

    end: int
    size: int
    id: int


class Links(dict):
    """Whether two pieces fit, worked out when first asked for."""

    def __init__(self, fits: Callable[[int, int], bool]) -> None:
        self.fits = fits

    def __missing__(self, pair: tuple[int, int]) -> bool:
        found = self[pair] = self.fits(*pair)
        return found


class Held(dict):
    """Values of a function by its argument, of the last arguments asked for: HELD, and up to as many before them."""

    def __init__(self, make: Callable[[str], bytes]) -> None:
        self.make, self.aged = make, {}

    def __missing__(self, word: str) -> bytes:
        if len(self) >= HELD:
            self.aged = dict(self)
            self.clear()
        value = self[word] = self.aged.pop(word, None) or self.make(word)
        return value


class Encoder:
    def __init__(self, spec: Spec) -> None:
        self.spec = spec
        self.cut = re.compile(spec.cut)
        self.words = not any(SPACE in piece.lstrip(SPACE) for piece in spec.ids)
        self.mark = re.compile(f"(?<!{SPACE}){SPACE}")
        self.held = Held(lambda word: array.array("i", self.one_path(word)).tobytes())
        self.links = Links(self._fits)
        self.bpe = spec.kind == "bpe"
        #: The pieces that an encoding can have, and by the first two characters of a longer piece the lengths there are.
        self.ids = {piece: i for piece, i in spec.ids.items() if not self.bpe or len(piece) == 1 or i in spec.parts}
        sizes: dict[str, set[int]] = {}
        for piece in self.ids:
            if len(piece) > 1:
                sizes.setdefault(piece[:2], set()).add(len(piece))
        self.sizes = {c: sorted(s) for c, s in sizes.items()}
        self.matches = ahocorasick.Automaton()
        for piece, i in self.ids.items():
            self.matches.add_word(piece, (i, len(piece)))
        self.matches.make_automaton()
        self.names = {i: piece for piece, i in spec.ids.items()}
        self.unknown = max(spec.rank.values(), default=0.0) + 10.0

    def arcs(self, text: str, at: int) -> list[Arc]:
        """The pieces that begin here, the character itself among them even if it is none."""
        ids = self.ids
        out = [Arc(at + 1, 1, ids.get(text[at], -1))]
        for n in self.sizes.get(text[at : at + 2], ()):
            i = ids.get(text[at : at + n])
            if i is not None and at + n <= len(text):
                out.append(Arc(at + n, n, i))
        return out

    def fits(self, a: int, b: int) -> bool:
        """BPE: whether a then b is how their joined text is encoded. Undoes both pieces' merges, the latest first."""
        if a < 0 or b < 0:
            return True
        return self.links[a, b]

    def _fits(self, a: int, b: int) -> bool:
        rank, parts, ids = self.spec.rank, self.spec.parts, self.spec.ids
        text = self.names
        # merges over the border that come before this one would have been made; on a tie the left one is first
        before: tuple[float, int] = (float("inf"), 0)
        while True:
            over = ids.get(text[a] + text[b])
            if over is not None and (rank[over], 0.5) < before:
                return False
            if a not in parts and b not in parts:
                return True
            if b not in parts or (a in parts and rank[a] > rank[b]):
                before, a = (rank[a], 0), parts[a][1]
            else:
                before, b = (rank[b], 1), parts[b][0]

    def weight(self, last: int | None, arc: Arc) -> float:
        if self.bpe:
            return 0.0 if last is None or self.fits(last, arc.id) else NEVER
        return -self.unknown if arc.id < 0 else -self.spec.rank[arc.id]

    def paths(self, text: str, start: int, last: int | None, end: int) -> dict[int, dict[int | None, tuple[float, Arc | None, int | None]]]:
        """The best paths from start, after a piece ``last`` (None: at a border), by where they end and their last piece.

        Pieces that begin before ``end`` are followed. For a unigram model all pieces that end in a place are one state.
        """
        at: dict[int, dict] = {start: {last: (0.0, None, None)}}
        for p in range(start, end):
            here = at.get(p)
            if here:
                for arc in self.arcs(text, p):
                    for state, (score, _, _) in here.items():
                        w = score + self.weight(state, arc)
                        if w > NEVER:
                            key = arc.id if self.bpe else None
                            there = at.setdefault(arc.end, {})
                            if key not in there or there[key][0] < w:
                                there[key] = (w, arc, state)
        return at

    def trace(self, text: str, at: dict, end: int, key: int | None, start: int) -> list[int]:
        out: list[int] = []
        while end > start:
            _, arc, state = at[end][key]
            out[:0] = self.piece_ids(text, arc)
            end, key = end - arc.size, state
        return out

    def piece_ids(self, text: str, arc: Arc) -> list[int]:
        if arc.id >= 0:
            return [arc.id]
        return [self.spec.byte_ids[b] for b in text[arc.end - 1].encode("utf-8", "replace")] if self.spec.byte_ids else [self.spec.unk]

    def stretch(self, word: str) -> list[int]:
        """Ids of a stretch between borders."""
        return np.frombuffer(self.held[word], "<i4").tolist()

    def one_path(self, word: str) -> list[int]:
        """The best path from border to border.

        For BPE just one path of weight 0 leads from a border to each place, so a place needs one state; the automaton yields
        the pieces by where they end.
        """
        n = len(word)
        if self.bpe:
            links = self.links
            last: list[int | None] = [None] * (n + 1)
            came = [0] * (n + 1)
            last[0] = -1
            for at, (b, size) in self.matches.iter(word):
                at += 1
                if last[at] is None:
                    a = last[at - size]
                    if a is not None and (a < 0 or links[a, b]):
                        last[at], came[at] = b, at - size
            if last[n] is not None:
                out = []
                while n:
                    out.append(last[n])
                    n = came[n]
                return out[::-1]
        at = self.paths(word, 0, None, n)
        return self.trace(word, at, n, max(at[n], key=lambda k: at[n][k][0]), 0)

    def score(self, ids: list[int]) -> float:
        """Unigram: the weight of a stretch's pieces. Bytes of one unknown character weigh as the character."""
        return sum(-self.spec.rank.get(i, self.unknown) for i in ids)

    def encode(self, marked: str) -> np.ndarray:
        if len(self.links) >= LINKS:
            self.links.clear()
        return np.frombuffer(b"".join(map(self.held.__getitem__, self.cut.findall(marked))), "<i4")

    # chunks: text is the chunk with up to longest - 1 characters of its surroundings; lo and hi are its cuts in it

    def covering(self, text: str, cut: int) -> list[Arc]:
        """The pieces that cover the character before a cut, the states there."""
        return [arc for s in range(max(0, cut - self.spec.longest), cut) for arc in self.arcs(text, s) if arc.end >= cut]

    def borders(self, text: str, lo: int, hi: int) -> tuple[int, int] | None:
        """The first and the last border in [lo, hi): places that no piece goes over. None: there is none that is sure.

        Where pieces hold marks only at their front, every mark that follows another character is a border, whatever
        surrounds it. A chunk without one is a single word, and is gone through as a whole.
        """
        if not self.words:
            return None
        first = self.mark.search(text, max(lo, 1), hi)
        if first is None:
            return None
        last = text.rfind(SPACE, 0, hi)
        while text[last - 1] == SPACE:
            last -= 1
        return first.start(), max(first.start(), last)

    def matrix(self, text: str, lo: int, hi: int, first: bool, last: bool) -> list[tuple[str, str, float]]:
        """(state at lo, state at hi, best weight); the state before a text is "start"; at its end all states are taken."""
        ins = [(lo, None, "start")] if first else [(a.end, a.id, state(a, lo)) for a in self.covering(text, lo)]
        ends = self.covering(text, hi)
        inner = self.borders(text, lo, hi)
        out = []
        if inner is None:
            for at, id_, name in ins:
                if at >= hi:  # the piece covers the whole chunk
                    out += [(name, state(a, hi), 0.0) for a in ends if (a.end, a.id) == (at, id_)]
                    continue
                paths = self.paths(text, at, id_, hi)
                out += [(name, state(a, hi), w) for a in ends for w in [self.into(paths, a)] if w > NEVER]
            return out
        b, c = inner
        tail = self.paths(text, c, None, hi)
        middle = 0.0 if self.bpe else sum(self.score(self.stretch(m)) for m in self.cut.findall(text[b:c]))
        right = [(state(a, hi), w) for a in ends if a.end - a.size >= c for w in [self.into(tail, a)] if w > NEVER]
        for at, id_, name in ins:
            if at > b:
                continue
            head = self.paths(text, at, id_, b).get(b, {})
            if head:
                best = max(x[0] for x in head.values())
                out += [(name, to, best + middle + w) for to, w in right]
        return out

    def into(self, paths: dict, arc: Arc) -> float:
        """The best weight of the paths whose last piece is this arc."""
        here = paths.get(arc.end - arc.size, {})
        return max((x[0] + self.weight(k, arc) for k, x in here.items()), default=NEVER)

    def chunk(self, text: str, lo: int, hi: int, enter: str, leave: str) -> list[int]:
        """Ids of the pieces that begin in the chunk, on the best path between two states."""
        at, id_ = (lo, None) if enter == "start" else next((a.end, a.id) for a in self.covering(text, lo) if state(a, lo) == enter)
        goal = next(a for a in self.covering(text, hi) if state(a, hi) == leave)
        if at >= hi:
            return []
        inner = self.borders(text, lo, hi)
        out: list[int] = []
        if inner is not None:
            b, c = inner
            head = self.paths(text, at, id_, b)
            if b > at:
                out += self.trace(text, head, b, max(head[b], key=lambda k: head[b][k][0]), at)
            out += self.encode(text[b:c]).tolist()
            at, id_ = c, None
        paths = self.paths(text, at, id_, hi)
        here = paths[goal.end - goal.size]
        key = max(here, key=lambda k: here[k][0] + self.weight(k, goal))
        return [*out, *self.trace(text, paths, goal.end - goal.size, key, at), *self.piece_ids(text, goal)]


_AT_WORK: dict[str, Encoder] = {}


def at_work(name: str, spec: Callable[[], Spec]) -> Encoder:
    """This worker's encoder of a model: what it holds of earlier tasks serves the next ones."""
    if name not in _AT_WORK:
        _AT_WORK.clear()
        _AT_WORK[name] = Encoder(spec())
    return _AT_WORK[name]


def state(arc: Arc, cut: int) -> str:
    """A state's name: how far before the cut its piece begins, and the piece's length and id."""
    return f"{cut - (arc.end - arc.size)}:{arc.size}:{arc.id}"


Cells = list[tuple[str, str, float]]


def product(left: Cells, right: Cells) -> Cells:
    """The max-plus product of two matrices of neighbouring stretches."""
    onward: dict[str, list[tuple[str, float]]] = {}
    for b, c, w in right:
        onward.setdefault(b, []).append((c, w))
    best: dict[tuple[str, str], float] = {}
    for a, b, v in left:
        for c, w in onward.get(b, ()):
            if best.get((a, c), NEVER) < v + w:
                best[a, c] = v + w
    return [(a, c, w) for (a, c), w in best.items()]


def best_states(chunks: list[tuple[int, Cells]], enter: str = "start", leave: str | None = None) -> list[tuple[int, str, str]]:
    """(number, state at its left, state at its right) on the best path through neighbouring matrices, between two states; the
    last one is the best there is if none is given."""
    ahead = {enter: 0.0}
    back: list[dict[str, str]] = []
    for _, cells in chunks:
        best: dict[str, tuple[float, str]] = {}
        for a, b, w in cells:
            if a in ahead and (b not in best or best[b][0] < ahead[a] + w):
                best[b] = (ahead[a] + w, a)
        ahead, came = {b: w for b, (w, _) in best.items()}, {b: a for b, (_, a) in best.items()}
        back.append(came)
    right = max(ahead, key=lambda k: ahead[k]) if leave is None else leave
    out = []
    for (n, _), came in zip(reversed(chunks), reversed(back), strict=True):
        out.append((n, came[right], right))
        right = came[right]
    return out[::-1]


STATES = "text_sha256 string, k int, enter string, leave string"


def in_runs(rows: DataFrame, work: Callable[[str, int, pa.Table], list[tuple]], schema: str, kinds: list[pa.DataType]) -> DataFrame:
    """work(text, run, rows) for every run of FAN neighbours of every text, dealt over all tasks."""
    by = ["text_sha256", "run"]
    names = [x.split()[0] for x in schema.split(", ")]
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def go(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in groups(batches, by):
            out = work(table.column("text_sha256")[0].as_py(), table.column("run")[0].as_py(), table)
            yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in out], t) for k, t in enumerate(kinds)], names)

    dealt = rows.withColumn("run", F.expr(f"k div {FAN}").cast("int")).repartition(parts, *by).sortWithinPartitions(*by, "k")
    return dealt.mapInArrow(lean(go), schema)


def matrices_of(table: pa.Table) -> list[tuple[int, Cells]]:
    return [(k, [(x["a"], x["b"], x["w"]) for x in c]) for k, c in zip(table.column("k").to_pylist(), table.column("cells").to_pylist(), strict=True)]


def states_at_cuts(cells: DataFrame, most: int) -> DataFrame:
    """(text_sha256, k, enter, leave): the states at both ends of every chunk, from the matrices of chunks 0 to at most ``most``."""

    def multiplied(text: str, run: int, table: pa.Table) -> list[tuple]:
        whole = functools.reduce(product, (c for _, c in matrices_of(table)))
        return [(text, run, [{"a": a, "b": b, "w": w} for a, b, w in whole])]

    def chosen(text: str, run: int, table: pa.Table) -> list[tuple]:
        enter, leave = ("start", None) if "enter" not in table.column_names else (table.column(c)[0].as_py() for c in ("enter", "leave"))
        return [(text, *x) for x in best_states(matrices_of(table), enter, leave)]

    kinds = [pa.string(), pa.int32(), pa.string(), pa.string()]
    levels = [cells]
    while most >= FAN:  # a level is read twice: on the way up and on the way down
        levels[-1] = written(levels[-1], "matrices")
        levels.append(in_runs(levels[-1], multiplied, "text_sha256 string, k int, cells array<struct<a:string,b:string,w:double>>", [pa.string(), pa.int32(), CELLS]))
        most //= FAN
    states = in_runs(levels[-1], chosen, STATES, kinds)
    for level in reversed(levels[:-1]):
        between = states.withColumnRenamed("k", "run")
        states = in_runs(level.withColumn("run", F.expr(f"k div {FAN}").cast("int")).join(between, ["text_sha256", "run"]).drop("run"), chosen, STATES, kinds)
    return states


def marked(text: str) -> str:
    """As the model reads it: a blank before it, and blanks as marks."""
    return SPACE + text.replace(" ", SPACE) if text else ""


def read_model(path: str) -> bytes:
    with open(path, "rb") as f:
        return f.read()


def encode(docs: DataFrame, model: bytes, chunk: int = CHUNK) -> DataFrame:
    """(doc_id, text_sha256, ids) for every row: the ids that the model's own library gives for the whole text.

    The digest is the text's (null for a null text), kept to check decoding. Null and empty texts have no ids. Texts of more
    than ``chunk`` characters go through the scan: their chunks are dealt over all tasks twice, once for the matrices and
    once to be traced back, and runs of FAN matrices in between. Equal giant texts are encoded once. Equal rows
    come out as often as they come in; a null doc_id stays null; other columns are ignored.
    """
    loaded, name = load(model), hashlib.sha256(model).hexdigest()
    spec = docs.sparkSession.sparkContext.broadcast(tuple(loaded))

    def plain(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = at_work(name, lambda: Spec(*spec.value))
        for batch in batches:
            for at in range(0, batch.num_rows, 1000):
                part = batch.slice(at, 1000)
                ids = [encoder.encode(marked(x.as_py() or "")) for x in part.column(1)]
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(2), lists(ids)], ["doc_id", "text_sha256", "ids"])

    rows = docs.select("doc_id", "text", F.sha2(F.col("text").cast("binary"), 256).alias("text_sha256"))
    whole = rows.where(is_small(chunk)).mapInArrow(lean(plain), "doc_id long, text_sha256 string, ids array<int>")
    return whole.unionByName(encode_giants(rows.where(~is_small(chunk)), loaded, name, chunk))


def is_small(chunk: int) -> Column:
    return F.coalesce(F.length("text") <= chunk, F.lit(True))


def encode_giants(giant: DataFrame, loaded: Spec, name: str, chunk: int) -> DataFrame:
    """encode() for texts (doc_id, text, text_sha256) that are cut in chunks."""
    spec = giant.sparkSession.sparkContext.broadcast(tuple(loaded))
    around = loaded.longest
    parts = (
        giant.select("text_sha256", "text").dropDuplicates(["text_sha256"])
        .withColumn("t", F.concat(F.lit(SPACE), F.replace("text", F.lit(" "), F.lit(SPACE))))
        .withColumn("n", F.ceil(F.length("t") / chunk).cast("int"))
        .select("text_sha256", "t", "n", F.explode(F.sequence(F.lit(0), F.col("n") - 1)).alias("k"))
        .select(
            "text_sha256", "k", (F.col("k") == F.col("n") - 1).alias("last"),
            F.least(F.col("k") * chunk, F.lit(around)).alias("lo"),
            F.least(F.lit(chunk), F.length("t") - F.col("k") * chunk).alias("size"),
            F.substring(F.col("t"), F.greatest(F.col("k") * chunk - around, F.lit(0)) + 1, F.lit(chunk + 2 * around)).alias("t"),
        )
    )
    parts = written(parts.select("text_sha256", "k", "last", "lo", (F.col("lo") + F.col("size")).alias("hi"), F.substring(F.col("t"), F.lit(1), F.col("lo") + F.col("size") + F.when(F.col("last"), 0).otherwise(around)).alias("t")), "chunks")

    def matrices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = at_work(name, lambda: Spec(*spec.value))
        for batch in (b.slice(at, 200) for b in batches for at in range(0, b.num_rows, 200)):
            cells = [encoder.matrix(r["t"], r["lo"], r["hi"], r["k"] == 0, r["last"]) for r in batch.to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array([[{"a": a, "b": b, "w": w} for a, b, w in c] for c in cells], CELLS)], ["text_sha256", "k", "cells"])

    def traced(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = at_work(name, lambda: Spec(*spec.value))
        for batch in (b.slice(at, 200) for b in batches for at in range(0, b.num_rows, 200)):
            ids = [np.array(encoder.chunk(r["t"], r["lo"], r["hi"], r["enter"], r["leave"]), np.int32) for r in batch.to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), lists(ids)], ["text_sha256", "k", "ids"])

    cells = parts.mapInArrow(lean(matrices), "text_sha256 string, k int, cells array<struct<a:string,b:string,w:double>>")
    states = states_at_cuts(cells, parts.agg(F.max("k")).first()[0] or 0)
    pieces = parts.join(states, ["text_sha256", "k"]).mapInArrow(lean(traced), "text_sha256 string, k int, ids array<int>")
    joined = pieces.groupBy("text_sha256").agg(F.flatten(F.transform(F.array_sort(F.collect_list(F.struct("k", "ids"))), lambda x: x.ids)).alias("ids"))
    return giant.select("doc_id", "text_sha256").join(joined, "text_sha256").select("doc_id", "text_sha256", "ids")


CELLS = pa.list_(pa.struct([("a", pa.string()), ("b", pa.string()), ("w", pa.float64())]))


def lists(ids: list[np.ndarray]) -> pa.Array:
    ends = np.cumsum([0, *map(len, ids)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(ids) if ids else np.empty(0, np.int32), pa.int32()))


class Decoder:
    def __init__(self, spec: Spec) -> None:
        of = {i: piece.replace(SPACE, " ").encode() for piece, i in spec.ids.items()} | {i: bytes([b]) for b, i in enumerate(spec.byte_ids)}
        of.setdefault(spec.unk, " ⁇ ".encode())
        held = [of.get(i, b"") for i in range(max(of) + 1)]
        self.pool = np.frombuffer(b"".join(held), np.uint8)
        self.size = np.array([len(x) for x in held])
        self.at = np.cumsum(self.size) - self.size

    def decode(self, ids: np.ndarray) -> bytes:
        """The bytes that the pieces of ids stand for, one after another."""
        size = self.size[ids]
        ends = np.cumsum(size)
        total = int(ends[-1]) if len(ends) else 0
        return self.pool[np.arange(total) + np.repeat(self.at[ids] - (ends - size), size)].tobytes()

    def texts(self, ids: list[np.ndarray]) -> list[str]:
        """Texts of lists of ids; bytes that are no UTF-8 come out as the replacement character. The mark before a text goes."""
        return [self.decode(x).decode("utf-8", "replace").removeprefix(" ") for x in ids]


def decode(rows: DataFrame, model: bytes) -> DataFrame:
    """(doc_id, text_sha256, n_tokens, ids_sha256, text): the text that each row's ids stand for.

    ids_sha256 is over the ids as little-endian 32-bit numbers. Null ids count as none, and none are the empty text.
    """
    spec = rows.sparkSession.sparkContext.broadcast(tuple(load(model)))
    schema = "doc_id long, text_sha256 string, n_tokens long, ids_sha256 string, text string"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decoder = Decoder(Spec(*spec.value))
        for batch in batches:
            for at in range(0, batch.num_rows, 1000):
                part = batch.slice(at, 1000)
                ids = [np.asarray(x.values.to_numpy() if x.is_valid else (), "<i4") for x in part.column(2)]
                columns = [pa.array(map(len, ids), pa.int64()), pa.array([hashlib.sha256(x.tobytes()).hexdigest() for x in ids]), pa.array(decoder.texts(ids), pa.string())]
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), *columns], ["doc_id", "text_sha256", "n_tokens", "ids_sha256", "text"])

    return rows.select("doc_id", "text_sha256", "ids").mapInArrow(lean(run), schema)


def round_trips(docs: DataFrame, model: bytes, chunk: int = CHUNK) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, round_trip): encode() and decode() of every row, and whether the text came back.

    The same ids and texts as these two give, and the same cases; but a text that is not cut is encoded, decoded and compared
    in one Python step, so neither ids nor texts go back to the JVM. A null text counts as empty.
    """
    loaded, name = load(model), hashlib.sha256(model).hexdigest()
    spec = docs.sparkSession.sparkContext.broadcast(tuple(loaded))

    def both(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, decoder = at_work(name, lambda: Spec(*spec.value)), Decoder(Spec(*spec.value))
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                part = batch.slice(at, 500)
                texts = [x.as_py() or "" for x in part.column(1)]
                ids = [encoder.encode(marked(x)) for x in texts]
                back = [a == b for a, b in zip(decoder.texts(ids), texts, strict=True)]
                columns = [pa.array(map(len, ids), pa.int64()), pa.array([hashlib.sha256(x.tobytes()).hexdigest() for x in ids], pa.string()), pa.array(back, pa.bool_())]
                yield pa.RecordBatch.from_arrays([part.column(0), *columns], ["doc_id", "n_tokens", "ids_sha256", "round_trip"])

    small = docs.select("doc_id", "text").where(is_small(chunk))
    whole = small.mapInArrow(lean(both), "doc_id long, n_tokens long, ids_sha256 string, round_trip boolean")
    giant = docs.select("doc_id", "text", F.sha2(F.col("text").cast("binary"), 256).alias("text_sha256")).where(~is_small(chunk))
    rest = decode(encode_giants(giant, loaded, name, chunk), model)
    same = F.sha2(F.col("text").cast("binary"), 256) == F.col("text_sha256")
    return whole.unionByName(rest.select("doc_id", "n_tokens", "ids_sha256", same.alias("round_trip")))
