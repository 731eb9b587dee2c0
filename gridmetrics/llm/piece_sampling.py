"""SentencePiece segmentations of a text, sampled without replacement, and decoding of piece ids.

The lattice of a text has an arc for each piece that fits, and the probability of a segmentation is in
proportion to the product of its pieces' weights. Distinct segmentations are drawn in the order of their
Gumbel-perturbed log probabilities by a search with exact bounds (A*): the bound of a set of
segmentations is the largest perturbed value in it. Following the best child from a node is a draw from
the arcs by their share of what is below; all other children of the nodes passed keep a truncated Gumbel
as their bound, and the next segmentation comes out of the largest of these. What remains largest after
the last draw is the threshold that gives each segmentation its inclusion score.

Pieces do not cross the space sign, so the lattice falls into units, whose arcs with their shares a
worker keeps. All texts of a batch walk the arcs together in numpy. Random numbers are hashes of the
row's key, the number of the draw and the place: a row gives the same result in any batch.

A model of merges holds ranks, not probabilities: there a piece's weight is (rank + 2) ** -``sharpness``.
Characters that are no piece go by bytes. Decoding gives the text back, but for the sign that stands for
a space, which decodes to a space.

Null or empty text has the one segmentation without pieces. A text with fewer segmentations than asked
for gives all it has; their inclusion is certain. Rows come out per input row and draw; repeated rows
give equal draws, and a null key is a key of its own. An empty table gives an empty result.
"""

from __future__ import annotations

import heapq
import re
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import sentencepiece
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.functions import pandas_udf

from gridmetrics.llm.batches import map_batches

SPACE = "▁"
_UNITS = re.compile(f"{SPACE}+[^{SPACE}]*|[^{SPACE}]+")

#: Arcs that a worker keeps before it starts anew with a batch.
KEPT_ARCS = 2_000_000

#: Characters of units whose arcs are found together.
SIGNS_TOGETHER = 150_000

#: Rows that walk together.
ROWS_TOGETHER = 300

#: Weight of a byte.
BYTE_WEIGHT = 1e-9

#: Fixed multipliers of a 64-bit mixing function.
_MIX = (np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB))
_STEP = np.uint64(0x9E3779B97F4A7C15)


def uniform(seeds: np.ndarray, draw: int, places: np.ndarray) -> np.ndarray:
    """Numbers above 0 and below 1 by row seed, draw and place."""
    x = seeds + (places.astype(np.uint64) * np.uint64(64) + np.uint64(draw)) * _STEP
    x = (x ^ (x >> np.uint64(30))) * _MIX[0]
    x = (x ^ (x >> np.uint64(27))) * _MIX[1]
    return ((x ^ (x >> np.uint64(31))) >> np.uint64(12)).astype(np.float64) * 2.0**-52 + 2.0**-53


class PieceLattice:
    """Pieces of a model file, and the arcs of the units met so far.

    The arcs of a node lie together from ``first`` on; ``upto`` adds up their shares, to 1 at the last.
    The arrays have room for more arcs than there are, so that new ones are put in without a copy of the others.
    """

    _KINDS = {"owner": np.int32, "upto": np.float64, "share": np.float64, "log_share": np.float64, "log_rest": np.float64, "piece": np.int32, "following": np.int32}

    def __init__(self, path: str, sharpness: float) -> None:
        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        size = self.model.get_piece_size()
        self.bytes, self.spelled, self.weights = {}, [b""] * size, np.zeros(size)
        ranked = self.model.get_score(size - 1) < -1000  # merges have scores 0, -1, -2, ...
        states, edges, self.number = {"": 0}, [], [-1]
        for number in range(size):
            piece = self.model.id_to_piece(number)
            if self.model.is_byte(number):
                self.bytes[int(piece[3:5], 16)] = number
                self.spelled[number], self.weights[number] = bytes([int(piece[3:5], 16)]), BYTE_WEIGHT
            elif not (self.model.is_control(number) or self.model.is_unknown(number) or self.model.is_unused(number)):
                score = self.model.get_score(number)
                self.weights[number] = (2 - score) ** -sharpness if ranked else np.exp(sharpness * score)
                self.spelled[number] = piece.replace(SPACE, " ").encode()
                for end in range(1, len(piece) + 1):
                    if piece[:end] not in states:
                        states[piece[:end]] = len(states)
                        self.number.append(-1)
                        edges.append((states[piece[: end - 1]] << 21 | ord(piece[end - 1]), states[piece[:end]]))
                self.number[states[piece]] = number
        #: Edges of the trie over pieces: state and character to the next state, and the piece that ends at a state.
        self.edges, self.next = np.array(sorted(edges), np.int64).T.copy()
        self.number = np.array(self.number)
        self.first = np.zeros(1, np.int32)
        for name, kind in self._KINDS.items():
            setattr(self, name, np.empty(0, kind))
        self.forget()

    def forget(self) -> None:
        self.units: dict[str, int] = {}
        self.arcs = self.nodes = 0

    def _room(self, name: str, size: int) -> np.ndarray:
        """The array of this name, made a quarter larger than needed if it is too small."""
        held = getattr(self, name)
        if size > len(held):
            held = np.concatenate([held, np.zeros(size + size // 4 - len(held), held.dtype)])
            setattr(self, name, held)
        return held

    def _add(self, owner: np.ndarray, upto: np.ndarray, share: np.ndarray, piece: np.ndarray, following: np.ndarray) -> None:
        """Put in the arcs of new nodes, which come after all others."""
        start, end = self.arcs, self.arcs + len(owner)
        with np.errstate(divide="ignore"):
            parts = {"owner": owner, "upto": upto, "share": share, "log_share": np.log(share), "log_rest": np.log1p(-share), "piece": piece, "following": following}
        for name, part in parts.items():
            self._room(name, end)[start:end] = part
        last = int(owner[-1]) + 1
        self._room("first", last + 1)[self.nodes : last + 1] = start + np.searchsorted(owner, np.arange(self.nodes, last + 1))
        self.arcs, self.nodes = end, last

    def roots(self, texts: list[list[str]]) -> list[np.ndarray]:
        """The first nodes of the units of each text; units not met so far are added."""
        new = {unit for units in texts for unit in units if unit not in self.units}
        by_length: dict[int, list[str]] = {}
        for unit in sorted(new):
            by_length.setdefault(len(unit), []).append(unit)
        for size, same in by_length.items():
            count = max(1, SIGNS_TOGETHER // size)
            for at in range(0, len(same), count):
                for part in self._lattice(same[at : at + count]):
                    self._add(*part)
        return [np.fromiter(map(self.units.__getitem__, units), np.int64, len(units)) for units in texts]

    def _lattice(self, units: list[str]) -> Iterator[tuple[np.ndarray, ...]]:
        """Owner, added and own share, piece and next node of the arcs of units of one length."""
        base = self.nodes
        size, count = len(units[0]), len(units)
        signs = np.array(units, f"<U{size}").view(np.uint32).reshape(count, size).astype(np.int64)
        found: list[tuple[np.ndarray, ...]] = []
        spelled = np.zeros((count, size), bool)
        for start in range(size):
            rows, states = np.arange(count), np.zeros(count, np.int64)
            for end in range(start + 1, size + 1):
                keys = states << 21 | signs[rows, end - 1]
                at = np.minimum(np.searchsorted(self.edges, keys), len(self.edges) - 1)
                on = self.edges[at] == keys
                rows, states = rows[on], self.next[at[on]]
                if not len(rows):
                    break
                pieces = self.number[states]
                whole = pieces >= 0
                found.append((rows[whole], np.full(whole.sum(), start), np.full(whole.sum(), end), pieces[whole]))
                if end == start + 1:
                    spelled[rows[whole], start] = True
        # Characters that are no piece go by their bytes, through nodes of their own after the others.
        extra: list[tuple[int, int, int, int]] = []
        extra_nodes = np.zeros(count, np.int64)
        for row, start in np.argwhere(~spelled):
            codes = units[row][start].encode()
            source = start
            for code in codes[:-1]:
                node = size + 1 + int(extra_nodes[row])
                extra_nodes[row] += 1
                extra.append((row, source, node, self.bytes[code]))
                source = node
            extra.append((row, source, start + 1, self.bytes[codes[-1]]))
        if extra:
            found.append(tuple(np.array(extra, np.int64).T))
        rows, starts, ends, pieces = (np.concatenate(x) for x in zip(*found, strict=True))
        width = size + 1 + int(extra_nodes.max(initial=0))
        order = np.argsort((rows * width + starts) * (width + 1) + ends, kind="stable")
        rows, starts, ends, pieces = rows[order], starts[order], ends[order], pieces[order]
        logs = np.log(self.weights[pieces])
        below = np.full((count, width), -np.inf)  # log weight of all ways from a node to the end
        below[:, size] = 0.0
        by_start = np.argsort(starts, kind="stable")
        bounds = np.searchsorted(starts[by_start], np.arange(size + 1))
        for start in range(size - 1, -1, -1):
            at = by_start[bounds[start] : bounds[start + 1]]
            if not len(at):
                continue
            ways = logs[at] + self._after(below, rows[at], ends[at], size, starts, rows, ends, logs)
            most = np.full(count, -np.inf)
            np.maximum.at(most, rows[at], ways)
            total = np.bincount(rows[at], np.exp(ways - most[rows[at]]), count)
            with np.errstate(divide="ignore", invalid="ignore"):
                below[:, start] = most + np.log(total)
            logs[at] = ways - below[rows[at], start]
        inner = starts > size
        logs[inner] = 0.0
        shares = np.exp(logs)
        nodes = np.concatenate([[0], np.cumsum(size + extra_nodes)])
        starts, ends = starts - (starts > size), np.where(ends == size, -1, ends - (ends > size))
        owner = base + nodes[rows] + starts
        added = np.cumsum(shares)
        begin = np.flatnonzero(np.diff(owner, prepend=-1))
        sizes = np.diff(np.append(begin, len(owner)))
        added -= np.repeat(added[begin] - shares[begin], sizes)
        added[begin + sizes - 1] = 1.0
        following = np.where(ends < 0, -1, base + nodes[rows] + ends)
        self.units.update(zip(units, (base + nodes[:-1]).tolist(), strict=True))
        yield owner, added, shares, pieces, following

    def _after(self, below, rows, ends, size, starts, all_rows, all_ends, logs) -> np.ndarray:  # noqa: ANN001
        """Log weight of all ways on from the ends of arcs; a byte's node has one way on."""
        out = np.zeros(len(rows))
        plain = ends <= size
        out[plain] = below[rows[plain], ends[plain]]
        for n in np.flatnonzero(~plain):
            row, node = rows[n], ends[n]
            while node > size:
                arc = np.flatnonzero((all_rows == row) & (starts == node))[0]
                out[n] += np.log(BYTE_WEIGHT)
                node = all_ends[arc]
            out[n] += below[row, node]
        return out


@lru_cache(maxsize=2)
def piece_lattice(path: str, sharpness: float) -> PieceLattice:
    return PieceLattice(path, sharpness)


def _bounded_gumbel(log_mass: np.ndarray, bound: float, chance: np.ndarray) -> np.ndarray:
    """Gumbel variables of the given log masses, below ``bound``."""
    with np.errstate(divide="ignore", over="ignore"):
        return log_mass - np.log(np.exp(log_mass - bound) - np.log(chance))


class _Row:
    """The search of one text."""

    def __init__(self, seed: int, roots: np.ndarray, places: np.ndarray) -> None:
        self.seed, self.roots, self.places = np.uint64(seed), roots, places
        self.paths: list[np.ndarray] = []
        self.bounds: list[float] = []
        #: Open sets: minus bound, path, place on it, arcs already taken there.
        self.open: list[tuple[float, int, int, tuple[int, ...]]] = []


class _Arcs:
    """The arcs of a lattice while a batch is at work."""

    def __init__(self, lattice: PieceLattice) -> None:
        self.first, self.owner, self.upto, self.share = lattice.first, lattice.owner, lattice.upto, lattice.share
        self.piece, self.following = lattice.piece, lattice.following
        self.log_share, self.log_rest = lattice.log_share, lattice.log_rest

    def walk(self, nodes: np.ndarray, roots: np.ndarray, places: np.ndarray, seeds: np.ndarray, draw: int) -> tuple[np.ndarray, np.ndarray]:
        """Arcs from each node to the end of its unit, one walk after the other, and the length of each walk."""
        going, steps = np.arange(len(nodes)), []
        lengths = np.zeros(len(nodes), np.int64)
        while len(going):
            chance = uniform(seeds[going], 4 * draw, places[going] + nodes - roots[going])
            taken = self.first[nodes]
            on = np.flatnonzero(self.upto[taken] < chance)
            while len(on):
                taken[on] += 1
                on = on[self.upto[taken[on]] < chance[on]]
            lengths[going] += 1
            steps.append((going, taken))
            nodes = self.following[taken]
            on = nodes >= 0
            going, nodes = going[on], nodes[on]
        begins = np.cumsum(lengths) - lengths
        walked = np.empty(int(lengths.sum()), np.int32)
        for number, (which, taken) in enumerate(steps):
            walked[begins[which] + number] = taken
        return walked, lengths

    def places_of(self, row: _Row, path: np.ndarray) -> np.ndarray:
        """A place in the text for each arc of a path, to draw numbers from."""
        units = np.cumsum(self.following[path] < 0) - (self.following[path] < 0)
        return row.places[units] + self.owner[path] - row.roots[units]

    def open_sets(self, row: _Row, number: int, begin: int, most: int) -> None:
        """Bounds of the sets that leave a new path at its places from ``begin`` on; the best go to the heap.

        The masses fall along a path. Where they are too small for any double below 1 to lift a bound to
        what the ``FAR`` first place could reach, the rest of the path is not looked at.
        """
        path, bound = row.paths[number], row.bounds[number]
        start = float(self.log_share[path[:begin]].sum())
        end = begin + 64
        while end < len(path) and start + self.log_share[path[begin:end]].sum() > min(bound, start) - FAR:
            end += end - begin
        path = path[:end]
        if begin >= len(path):
            return
        before = np.cumsum(self.log_share[path]) - self.log_share[path]
        chance = uniform(row.seed, 4 * number + 1, self.places_of(row, path)[begin:])
        bounds = _bounded_gumbel(before[begin:] + self.log_rest[path[begin:]], bound, chance)
        for at in np.argsort(-bounds, kind="stable")[:most]:
            if bounds[at] > -np.inf:
                heapq.heappush(row.open, (-float(bounds[at]), number, begin + int(at), (int(path[begin + at]),)))

    def branch(self, row: _Row, draw: int) -> tuple[np.ndarray, int, int, int] | None:
        """Takes the best open set: the common arcs, the new arc, its unit and its node's unit root."""
        if not row.open:
            return None
        bound, number, at, taken = heapq.heappop(row.open)
        path = row.paths[number]
        node = int(self.owner[path[at]])
        low, high = self.first[node], self.first[node + 1]
        arcs = np.setdiff1d(np.arange(low, high), taken)
        shares = self.share[arcs]
        place = self.places_of(row, path[: at + 1])[-1:]
        chance = uniform(row.seed, 4 * draw + 2, place)[0]
        chosen = int(arcs[min(np.searchsorted(np.cumsum(shares), chance * shares.sum()), len(arcs) - 1)])
        row.bounds.append(-bound)
        taken = (*taken, chosen)
        rest = np.setdiff1d(arcs, taken)
        if len(rest) and self.share[rest].sum() > 0:
            mass = float(self.log_share[path[:at]].sum() + np.log(self.share[rest].sum()))
            left = float(_bounded_gumbel(np.array([mass]), -bound, uniform(row.seed, 4 * draw + 3, place))[0])
            heapq.heappush(row.open, (-left, number, at, taken))
        unit = int((self.following[path[:at]] < 0).sum())
        return path[:at], chosen, unit, at


#: In logarithms, how much smaller a mass is beyond reach: over ln(2 ** 53), the range of the random numbers.
FAR = 80.0

#: Segmentations that can be asked for.
MOST_DRAWS = 15


def sampled(texts: list[str], seeds: list[int], lattice: PieceLattice, draws: int) -> list[list[tuple[np.ndarray, float, float, float]]]:
    """For each text its segmentations in the order drawn: ids, log probability, perturbed value, log inclusion."""
    if not 0 < draws <= MOST_DRAWS:
        raise ValueError(f"draws must be from 1 to {MOST_DRAWS}")
    if lattice.arcs > KEPT_ARCS:
        lattice.forget()
    units = [_UNITS.findall(SPACE + text.replace(" ", SPACE)) if text else [] for text in texts]
    places = [np.cumsum([0, *map(len, some)])[:-1] * 4 for some in units]
    rows = [_Row(*x) for x in zip(seeds, lattice.roots(units), places, strict=True)]
    arcs = _Arcs(lattice)
    for draw in range(draws):
        jobs, nodes, which, roots, places = [], [], [], [], []
        for row in rows:
            if draw == 0:
                row.bounds.append(float(-np.log(-np.log(uniform(row.seed, 3, np.array([-1]))[0]))))
                begun, unit, begin = np.empty(0, np.int64), 0, 0
                first = np.empty(0, np.int64)
            else:
                found = arcs.branch(row, draw)
                if found is None:
                    continue
                begun, chosen, unit, at = found
                begun, begin = np.append(begun, chosen), at + 1
                node = arcs.following[chosen]
                first = np.array([node] if node >= 0 else [], np.int64)
                unit += int(node < 0)
            jobs.append((row, begun, begin))
            some = row.roots[unit:]
            nodes.append(np.concatenate([first, some[len(first) :]]))
            roots.append(some)
            places.append(row.places[unit:])
            which.append(len(some))
        if not jobs:
            break
        seeds_of = np.repeat(np.array([row.seed for row, *_ in jobs], np.uint64), which)
        walked, lengths = arcs.walk(np.concatenate(nodes), np.concatenate(roots), np.concatenate(places), seeds_of, draw)
        ends = np.concatenate([[0], np.cumsum(lengths)])[np.concatenate([[0], np.cumsum(which)])]
        for number, (row, begun, begin) in enumerate(jobs):
            row.paths.append(np.concatenate([begun, walked[ends[number] : ends[number + 1]]]))
            arcs.open_sets(row, len(row.paths) - 1, begin, draws + 1)
    results = []
    for row in rows:
        limit = -row.open[0][0] if row.open else -np.inf
        out = []
        for path, bound in zip(row.paths, row.bounds, strict=True):
            chance = float(arcs.log_share[path].sum())
            over = chance - limit
            inclusion = over if over < -30 else float(np.log(-np.expm1(-np.exp(min(over, 50.0)))))
            out.append((arcs.piece[path], chance, bound, inclusion))
        results.append(out)
    return results


def decoded(ids: np.ndarray, lattice: PieceLattice) -> str:
    """The text of piece ids, without the space that encoding puts first."""
    return b"".join(map(lattice.spelled.__getitem__, ids.tolist())).decode(errors="replace").removeprefix(" ")


def sampled_pieces(
    docs: DataFrame, path: str, draws: int, sharpness: float = 1.0, id_column: str = "doc_id", text_column: str = "text", with_ids: bool = True
) -> DataFrame:
    """Per row and draw: the id, ``draw``, ``n_pieces``, ``log_prob``, ``perturbed``, ``log_inclusion``,
    ``ids_crc32`` (of little-endian 32-bit ids), ``decodes`` (whether they give the text back) and ``ids`` if asked for.
    """
    source = docs.select(F.col(id_column).alias("id"), F.col(text_column).alias("text"))

    def sample(batch: pa.RecordBatch) -> pa.RecordBatch:
        lattice = piece_lattice(path, sharpness)
        rows, found = [], []
        for at in range(0, batch.num_rows, ROWS_TOGETHER):
            part = batch.slice(at, ROWS_TOGETHER)
            texts = [x or "" for x in part.column(1).to_pylist()]
            seeds = [xxhash.xxh3_64_intdigest(str(x).encode()) for x in part.column(0).to_pylist()]
            for row, (text, some) in enumerate(zip(texts, sampled(texts, seeds, lattice, draws), strict=True)):
                plain = text.replace(SPACE, " ")
                for draw, (ids, chance, bound, inclusion) in enumerate(some):
                    rows.append(at + row)
                    data = ids.astype("<u4")
                    found.append((draw, len(ids), chance, bound, inclusion, zlib.crc32(data.tobytes()), decoded(ids, lattice) == plain, ids if with_ids else None))
        kinds = [pa.int32(), pa.int64(), pa.float64(), pa.float64(), pa.float64(), pa.int64(), pa.bool_(), pa.list_(pa.int32())]
        names = ["draw", "n_pieces", "log_prob", "perturbed", "log_inclusion", "ids_crc32", "decodes", "ids"]
        columns = [pa.array(list(x), kind) for x, kind in zip(zip(*found, strict=True) if found else [[]] * 8, kinds, strict=True)]
        keep = 8 if with_ids else 7
        return pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(rows, pa.int64())), *columns[:keep]], ["id", *names[:keep]])

    kind = source.schema["id"].dataType.simpleString()
    schema = f"id {kind}, draw int, n_pieces long, log_prob double, perturbed double, log_inclusion double, ids_crc32 long, decodes boolean"
    return map_batches(source, sample, schema + ", ids array<int>" * with_ids).withColumnRenamed("id", id_column)


def decode_pieces(ids: Column, path: str) -> Column:
    """The text of an array of piece ids."""

    @pandas_udf("string")
    def decode(lists):  # noqa: ANN001, ANN202
        lattice = piece_lattice(path, 1.0)
        return lists.map(lambda x: decoded(np.asarray(x, np.int64), lattice))

    return decode(ids)
