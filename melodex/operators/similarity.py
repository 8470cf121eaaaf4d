"""Similarity of seed items to all items.

Every seed is scored against every item, as the ranking needs, but no pair becomes a row that is shuffled: a task holds a
block of seeds while all items pass by, some at a time, and returns only what can matter: the k best items per seed, or
their range. No list per block of items is shuffled, and what a task holds has a bounded size whatever the data.

Items are shuffled and stored once, in the order of their ids; every task reads them from there. So no row is copied,
however many blocks of seeds there are.
"""

from __future__ import annotations

import math
import sys
from collections.abc import Callable, Iterator, Sequence
from functools import cached_property
from itertools import chain
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from melodex.functions.scoring import MINMAX_EPSILON, RANK_SCALE
from melodex.operators.ranking import top_k
from melodex.session import materialise

# tasks carry these functions along, so executors need no copy of the package
cloudpickle.register_pickle_by_value(sys.modules[__name__])

TILE_ROWS = 131072
# what is scored at once
SLICE_ROWS = 256
CHUNK_ITEMS = 8192
NEAR_ITEMS = 2048
# items that are ruled out together, and seeds that one bound is for
BLOCK_ITEMS = 64
BOUND_ROWS = 16
# categories of a column that such a block tells apart
KNOWN_CATEGORIES = 1024
EXACT_PAIRS = 65536
# items are stored by so many rows, or fewer with so many plays
PACKED_ROWS = 512
PACKED_PLAYS = 1 << 16
# items of a stored range, about; a range is sorted in a task
RANGE_ROWS = 1 << 20
# seeds that are drawn to cut them into blocks of like ones, for a block and in all
DRAWN_SEEDS = 64
MOST_DRAWN = 16384
# one-hot columns of up to so many categories are widened inside a task
NARROW_CATEGORIES = 64


# ---- inside a task -------------------------------------------------------------------------------


def _array(column: pa.ChunkedArray) -> pa.Array:
    return column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column


def _matrix(column: pa.ChunkedArray) -> np.ndarray:
    lists = _array(column)
    values = lists.flatten().to_numpy(zero_copy_only=False)
    if not np.isfinite(values).all():
        raise ValueError("feature vectors must be finite: null, NaN and infinite components can't be ranked")
    return values.reshape(len(lists), -1)


def _codes(items: pa.ChunkedArray, seeds: pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """Category arrays of both sides as shared integer codes; unknown categories never match."""
    left, right = _array(items), _array(seeds)
    both = pa.concat_arrays([left.flatten(), right.flatten()]).dictionary_encode().indices
    split = len(left.flatten())
    codes = both.to_numpy(zero_copy_only=False) if both.null_count == 0 else both.fill_null(-1).to_numpy()
    width = split // len(left)
    of_items = codes[:split].reshape(len(left), width)
    of_seeds = codes[split:].reshape(len(right), width)
    return of_items, np.where(of_seeds < 0, -2, of_seeds)


def _true(mask: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Row and column of what is true, where little is: eight cells are looked at together."""
    cells = np.ascontiguousarray(mask).reshape(-1)
    if len(cells) % 8:
        return np.divmod(np.flatnonzero(cells), mask.shape[1])
    words = np.flatnonzero(cells.view(np.uint64))
    word, place = np.nonzero(cells.reshape(-1, 8)[words])
    return np.divmod(words[word] * 8 + place, mask.shape[1])


class Tile:
    """Cosines between the seeds and the items of one tile, a slice of seeds and a chunk of items at a time.

    Single precision, whose error is bounded by ``slack``, says which pairs can matter; only these are scored in double
    precision, and only those scores are compared or returned.

    Items are taken in the order of their categories and the lengths of their dense parts. What a slice of seeds and a block of
    items have in common bounds their cosines: with lengths a and b, m equal categories of c, by (ab + m) / sqrt((a² + c)(b² + c)).
    """

    def __init__(self, items: pa.Table, seeds: pa.Table):
        self.tables = items, seeds
        self.item_ids = _array(items["item"])
        self.seed_ids = _array(seeds["seed"])
        self.items = _matrix(items["dense"])
        self.seeds = _matrix(seeds["dense"])
        self.item_codes, self.seed_codes = _codes(items["cats"], seeds["cats"])
        self.item_lengths = np.sqrt((self.items**2).sum(axis=1))
        self.seed_lengths = np.sqrt((self.seeds**2).sum(axis=1))
        item_norms = np.sqrt(self.item_lengths**2 + (self.item_codes >= 0).sum(axis=1))
        seed_norms = np.sqrt(self.seed_lengths**2 + (self.seed_codes >= 0).sum(axis=1))
        # a zero vector has cosine 0 with everything
        self.item_norms = np.where(item_norms > 0, item_norms, np.inf)
        self.seed_norms = np.where(seed_norms > 0, seed_norms, np.inf)
        self.near_items = None

    def slices(self):
        for start in range(0, len(self.seed_ids), SLICE_ROWS):
            part = slice(start, start + SLICE_ROWS)
            scores = self.seeds[part] @ self.items.T
            for c in range(self.item_codes.shape[1]):
                scores += self.seed_codes[part, c, None] == self.item_codes[None, :, c]
            scores /= self.seed_norms[part, None]
            scores /= self.item_norms[None, :]
            yield part, scores

    def parts(self) -> Iterator[slice]:
        starts = _cuts(self.seed_codes, SLICE_ROWS)
        for start, stop in zip(starts, np.append(starts, len(self.seed_ids))[1:]):
            yield slice(int(start), int(stop))

    @cached_property
    def own(self) -> np.ndarray:
        """Column of each seed that is itself among the items, -1 of the others."""
        return pc.index_in(self.seed_ids, value_set=self.item_ids).fill_null(-1).to_numpy(zero_copy_only=False)

    def own_columns(self, part: slice) -> tuple[np.ndarray, np.ndarray]:
        """Row and column of each seed of the slice that is itself among the items."""
        rows = np.flatnonzero(self.own[part] >= 0)
        return rows, self.own[part][rows]

    def _prepare(self) -> None:
        """Unit vectors of both sides in single precision, narrow one-hot columns widened."""
        both = range(self.item_codes.shape[1])
        known = {c: np.intersect1d(self.item_codes[:, c], self.seed_codes[:, c]) for c in both}
        self.wide = [c for c in both if len(known[c]) > NARROW_CATEGORIES]

        def unit(matrix: np.ndarray, codes: np.ndarray, norms: np.ndarray) -> np.ndarray:
            blocks = [(matrix / norms[:, None]).astype(np.float32)]
            for c in both:
                if c not in self.wide:
                    blocks.append(((codes[:, c, None] == known[c][None, :]) / norms[:, None]).astype(np.float32))
            return np.ascontiguousarray(np.hstack(blocks))

        self._sort()
        self.places = np.argsort(self.order)
        self.near_items = unit(self.items, self.item_codes, self.item_norms)[self.order]
        self.near_seeds = unit(self.seeds, self.seed_codes, self.seed_norms)
        # a sum of n rounded products of unit vectors is off by less than n + 4 units in the last place
        self.slack = (self.near_items.shape[1] + 4 * len(self.wide) + 8) * 2.0**-23
        self.buffer = np.empty(SLICE_ROWS * NEAR_ITEMS, np.float32)
        self._bound_blocks()

    def _sort(self) -> None:
        """The items' order, and where its blocks start."""
        self.order = _by_categories(self.item_codes, self.item_lengths)
        self.starts = np.append(_cuts(self.item_codes[self.order], BLOCK_ITEMS), len(self.order))

    def _bound_blocks(self) -> None:
        """What bounds the cosines of each block of items."""
        lengths, codes = self.item_lengths[self.order], self.item_codes[self.order]
        starts, block = self.starts[:-1], np.repeat(np.arange(len(self.starts) - 1), np.diff(self.starts))
        self.least, self.most = np.minimum.reduceat(lengths, starts), np.maximum.reduceat(lengths, starts)
        self.fewest = np.minimum.reduceat((codes >= 0).sum(axis=1), starts).astype(float)
        self.holds = []
        for c in range(codes.shape[1]):
            known = np.flatnonzero(codes[:, c] >= 0)
            width = min(KNOWN_CATEGORIES, int(max(codes[:, c].max(initial=0), self.seed_codes[:, c].max(initial=0))) + 1)
            holds = np.zeros((len(starts), width), np.float32)
            holds[block[known], codes[known, c] % width] = 1
            self.holds.append(holds)

    def bounds(self, part: slice) -> np.ndarray:
        """What no cosine exceeds of some seeds of the slice (each ``BOUND_ROWS`` a row) and a block of items (a column each)."""
        if self.near_items is None:
            self._prepare()
        codes = self.seed_codes[part]
        m = np.zeros(len(self.least))
        for c, holds in enumerate(self.holds):
            sought = np.zeros(holds.shape[1], np.float32)
            sought[codes[codes[:, c] >= 0, c] % holds.shape[1]] = 1
            m += holds @ sought > 0
        starts = np.arange(0, len(codes), BOUND_ROWS)
        low, high = (end.reduceat(self.seed_lengths[part], starts)[:, None] for end in (np.minimum, np.maximum))
        few = np.minimum.reduceat((codes >= 0).sum(axis=1), starts).astype(float)[:, None]
        highest = np.zeros((len(starts), len(m)))
        with np.errstate(all="ignore"):
            # the largest value lies on the edges of both ranges; on each of them there is one top
            edges = [(a, np.clip(np.where(m > 0, a * self.fewest / m, np.inf), self.least, self.most)) for a in (low, high)]
            edges += [(np.clip(np.where(m > 0, b * few / m, np.inf), low, high), b) for b in (self.least, self.most)]
            for a, b in edges:
                value = (a * b + m) / np.sqrt((a**2 + few) * (b**2 + self.fewest))
                highest = np.maximum(highest, np.where(np.isfinite(value), value, 1.0))
        return np.minimum(highest, 1.0) + 1e-9

    def near(self, part: slice, places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Columns and the approximate scores of the items at some places of their order; the scores are overwritten by the next."""
        if places[-1] - places[0] < len(places):
            places = slice(places[0], places[-1] + 1)
        columns, items = self.order[places], self.near_items[places]
        n = part.stop - part.start
        near = self.buffer[: n * len(columns)].reshape(n, len(columns)) if n * len(columns) <= len(self.buffer) else None
        near = np.matmul(self.near_seeds[part], items.T, out=near)
        for c in self.wide:
            rows, at = np.nonzero(self.seed_codes[part, c, None] == self.item_codes[None, columns, c])
            near[rows, at] += 1 / self.seed_norms[part][rows] / self.item_norms[columns][at]
        return columns, near

    def passing(self, limits: np.ndarray, groups: np.ndarray, least: Callable[[], np.ndarray]) -> Iterator[np.ndarray]:
        """Places of the items of the blocks that can matter, those of the highest limits first: where a limit of some seeds (rows
        begin at ``groups``) reaches what one of them needs at ``least`` by then."""
        by_limit, at, sizes = np.argsort(-limits.max(axis=0), kind="stable"), 0, np.diff(self.starts)
        before = np.append(0, np.cumsum(sizes[by_limit]))
        while at < len(by_limit):
            stop = max(at + 1, int(np.searchsorted(before, before[at] + NEAR_ITEMS, "right")) - 1)
            blocks, needed = by_limit[at:stop], np.minimum.reduceat(least(), groups)[:, None]
            if (limits[:, blocks[0]].max() < needed).all():
                break
            blocks, at = np.sort(blocks[(limits[:, blocks] >= needed).any(axis=0)]), stop
            if len(blocks):
                of_block = sizes[blocks]
                yield np.repeat(self.starts[blocks] - np.cumsum(of_block) + of_block, of_block) + np.arange(of_block.sum())

    def exact(self, part: slice, rows: np.ndarray, columns: np.ndarray) -> np.ndarray:
        """Cosines of the pairs of a row of the slice and an item."""
        scores = np.empty(len(rows))
        for start in range(0, len(rows), EXACT_PAIRS):
            some = slice(start, start + EXACT_PAIRS)
            s, i = rows[some] + part.start, columns[some]
            found = np.einsum("ij,ij->i", self.seeds[s], self.items[i])
            for c in range(self.item_codes.shape[1]):
                found += self.seed_codes[s, c] == self.item_codes[i, c]
            scores[some] = found / self.seed_norms[s] / self.item_norms[i]
        return scores

    def best(
        self, part: slice, k: int, blend: Blend | None = None, lists: Lists | None = None
    ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Row, column and score of each seed's k best items, the seed itself left out; without ``lists`` items must be sorted by
        id. With ``lists`` of the items before, those of both, by place."""
        n = part.stop - part.start
        limits = self.bounds(part)
        own = np.full(n, -1)
        own_rows, own_columns = self.own_columns(part)
        own[own_rows], own_places = own_columns, self.places[own_columns]
        found, pending, waiting = (np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)) if lists is None else lists.of(part), [], 0
        given = np.full(n, -np.inf) if lists is None else lists.floors[part]
        floor = np.maximum(_floor(n, k, found), given)  # the k-th best score so far, or less

        def add(rows: np.ndarray, columns: np.ndarray, scores: np.ndarray) -> None:
            nonlocal found, floor, pending, waiting
            high = ~(scores < floor[rows] - 2 / RANK_SCALE)
            rows, columns, scores = rows[high], columns[high], scores[high]
            pending.append((rows, columns if lists is None else lists.here[columns], scores))
            waiting += len(rows)
            if waiting and (waiting > n * k or not np.isfinite(floor).all()):
                found = _first(n, k, [found, *pending])
                floor, pending, waiting = np.maximum(_floor(n, k, found), given), [], 0

        if blend is not None and len(blend.rows):
            # pairs that share listeners are few, and have scores of their own
            other = np.flatnonzero(blend.columns != own[blend.rows])
            for start in range(0, len(other), EXACT_PAIRS):
                some = other[start : start + EXACT_PAIRS]
                rows, columns = blend.rows[some], blend.columns[some]
                add(rows, columns, blend.exact(rows, columns, self.exact(part, rows, columns)))
        in_order = blend is None or blend.rise.min(initial=0.0) >= 0

        def least() -> np.ndarray:
            return (floor if blend is None else blend.cosines(floor)) - self.slack - 2 / RANK_SCALE

        for places in self.passing(limits, np.arange(0, n, BOUND_ROWS), least):
            wanted, width = least(), len(places)
            columns, near = self.near(part, places)
            at_own = np.searchsorted(places, own_places)
            here = np.flatnonzero(places[np.minimum(at_own, width - 1)] == own_places)
            near[own_rows[here], at_own[here]] = -np.inf
            if k < width and in_order and not np.isfinite(floor).all():
                wanted = np.maximum(wanted, np.partition(near, width - k, axis=1)[:, width - k] - 2 * self.slack - 2 / RANK_SCALE)
            wanted = np.nextafter(np.maximum(wanted, -1e38).astype(np.float32), np.float32(-np.inf))
            rows, cells = _true(near >= wanted[:, None])
            if not len(rows):
                continue
            chosen = columns[cells]
            if blend is not None:
                alone = np.flatnonzero(~blend.shares(rows, chosen))
                rows, chosen = rows[alone], chosen[alone]
            scores = self.exact(part, rows, chosen)
            add(rows, chosen, scores if blend is None else blend.exact(rows, chosen, scores))
        return _first(n, k, [found, *pending])

    def highest(self, part: slice, ends: np.ndarray) -> None:
        """Raise ``ends`` to the highest cosine of each seed of the slice, the seed itself included."""
        for places in self.passing(self.bounds(part), np.arange(0, len(ends), BOUND_ROWS), lambda: ends - self.slack):
            columns, near = self.near(part, places)
            bound = np.maximum(np.maximum(ends, near.max(axis=1) - self.slack) - self.slack, -1e38).astype(np.float32)
            rows, cells = _true(near >= np.nextafter(bound, np.float32(-np.inf))[:, None])
            np.maximum.at(ends, rows, self.exact(part, rows, columns[cells]))

    def ranges(self, part: slice) -> tuple[np.ndarray, np.ndarray]:
        """Lowest and highest cosine of each seed of the slice, the seed itself included."""
        low, high = np.full(part.stop - part.start, np.inf), np.full(part.stop - part.start, -np.inf)
        self.highest(part, high)
        self.far.lowest(part, low)
        return low, high

    @cached_property
    def far(self) -> FarTile:
        return FarTile(*self.tables)


class FarTile(Tile):
    """The same for the lowest cosines: items are in the order of their dense parts, so that a block holds like ones. A block's
    centre and radius, and its least and greatest values, bound the products of the dense parts; equal categories only add."""

    def _sort(self) -> None:
        self.dense = (self.items / self.item_norms[:, None]).astype(np.float32)
        blocks = _by_likeness(self.dense, BLOCK_ITEMS)
        self.order = np.concatenate(blocks)
        self.starts = np.cumsum([0, *map(len, blocks)])

    def _bound_blocks(self) -> None:
        dense, starts, sizes = self.dense[self.order], self.starts[:-1], np.diff(self.starts)
        self.low, self.high = np.minimum.reduceat(dense, starts), np.maximum.reduceat(dense, starts)
        self.centres = np.add.reduceat(dense, starts) / sizes[:, None].astype(np.float32)
        radii = np.maximum.reduceat(np.linalg.norm(dense - np.repeat(self.centres, sizes, axis=0), axis=1), starts)
        self.radii = radii * (1 + 1e-5) + 1e-6
        corners = np.linalg.norm(np.maximum(np.abs(self.low), np.abs(self.high)), axis=1)
        self.margins = (2 * dense.shape[1] + 16) * 2.0**-23 * (1 + corners)
        del self.dense

    def bounds(self, part: slice) -> np.ndarray:
        """What no cosine of a seed of the slice (a row each) and an item of a block (a column each) lies below, as a negative."""
        if self.near_items is None:
            self._prepare()
        seeds = (self.seeds[part] / self.seed_norms[part, None]).astype(np.float32)
        lengths = np.linalg.norm(seeds, axis=1) * (1 + 1e-5)
        ball = seeds @ self.centres.T - lengths[:, None] * self.radii
        box = np.maximum(seeds, 0) @ self.low.T + np.minimum(seeds, 0) @ self.high.T
        return self.margins - np.maximum(ball, box)

    def lowest(self, part: slice, ends: np.ndarray) -> None:
        """Reduce ``ends`` to the lowest cosine of each seed of the slice."""
        for places in self.passing(self.bounds(part), np.arange(len(ends)), lambda: -ends - self.slack):
            columns, near = self.near(part, places)
            bound = np.minimum(np.minimum(ends, near.min(axis=1) + self.slack) + self.slack, 1e38).astype(np.float32)
            rows, cells = _true(near <= np.nextafter(bound, np.float32(np.inf))[:, None])
            np.minimum.at(ends, rows, self.exact(part, rows, columns[cells]))


def _by_likeness(rows: np.ndarray, most: int) -> list[np.ndarray]:
    """Rows in groups of ``most`` at most: halved at the mean of the column in which some of them differ most, rows that are
    alike by number."""
    found, open_groups = [], [np.arange(len(rows))]
    while open_groups:
        group = open_groups.pop()
        if len(group) <= most:
            if len(group):
                found.append(group)
            continue
        some = rows[group[:: max(1, len(group) // 256)]]
        column = int(some.var(axis=0).argmax()) if rows.shape[1] else 0
        above = rows[group, column] > some[:, column].mean() if rows.shape[1] else np.zeros(len(group), bool)
        if above.all() or not above.any():
            above = np.arange(len(group)) * 2 >= len(group)
        open_groups += [group[above], group[~above]]
    return found


def _by_categories(codes: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The order of the rows by categories, those of the column with the fewest first, and by lengths."""
    fewest = sorted(range(codes.shape[1]), key=lambda c: len(np.unique(codes[:, c])))
    return np.lexsort((lengths, *(codes[:, c] for c in reversed(fewest))))


def _cuts(codes: np.ndarray, most: int) -> np.ndarray:
    """Where to cut rows in the order of their categories: into ``most`` at most, and before other categories, unless less than a
    quarter of that would come of it."""
    if not len(codes):
        return np.zeros(0, np.int64)
    changes = np.flatnonzero((codes[1:] != codes[:-1]).any(axis=1)) + 1
    cuts, start = [], 0
    ends = np.append(changes, len(codes)).tolist()
    for i, end in enumerate(ends):
        after = ends[i + 1] if i + 1 < len(ends) else end
        if 4 * (end - start) >= most or after - start > most or end == len(codes):
            n = -(-(end - start) // most)
            cuts += [start + (end - start) * j // n for j in range(n)]
            start = end
    return np.array(cuts, np.int64)


def _rank_keys(scores: np.ndarray) -> np.ndarray:
    return np.floor(np.nan_to_num(scores, nan=-4e6) * RANK_SCALE + 0.5)


def _first(n: int, k: int, parts: list[tuple]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The k best (row, column, score) of each row by score, then column."""
    rows, columns, scores = (np.concatenate(x) for x in zip(*parts))
    order = np.lexsort((columns, -_rank_keys(scores), rows))
    rows = rows[order]
    counts = np.bincount(rows, minlength=n)
    place = np.arange(len(rows)) - (np.cumsum(counts) - counts)[rows]
    order = order[place < k]
    return rows[place < k], columns[order], scores[order]


def _floor(n: int, k: int, found: tuple) -> np.ndarray:
    """The k-th best score of each row of what ``_first`` gives, -inf for shorter rows."""
    ends = np.cumsum(np.bincount(found[0], minlength=n))
    full = np.diff(ends, prepend=0) == k
    floor = np.full(n, -np.inf)
    floor[full] = np.nan_to_num(found[2][ends[full] - 1], nan=-np.inf)
    return floor


class Lists:
    """The k best items so far of each seed of a block, while the items pass by. Places are in the order of their ids."""

    def __init__(self, seed_ids: pa.Array, k: int):
        self.seed_ids, self.k = seed_ids, k
        self.places = np.zeros((len(seed_ids), k), np.int64)  # of the items among all that passed
        self.scores = np.zeros((len(seed_ids), k))
        self.sizes = np.zeros(len(seed_ids), np.int64)
        self.here, self.passed = np.zeros(0, np.int64), []
        self.floors = np.full(len(seed_ids), -np.inf)  # scores that the k-th best will reach

    def of(self, part: slice) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        listed = np.arange(self.k) < self.sizes[part, None]
        return np.nonzero(listed)[0], self.places[part][listed], self.scores[part][listed]

    def put(self, part: slice, rows: np.ndarray, places: np.ndarray, scores: np.ndarray) -> None:
        """Replace the lists of the slice; rows in order."""
        sizes = np.bincount(rows, minlength=part.stop - part.start)
        at = np.arange(len(rows)) - (np.cumsum(sizes) - sizes)[rows]
        self.places[part][rows, at], self.scores[part][rows, at], self.sizes[part] = places, scores, sizes

    def add(self, part: slice, rows: np.ndarray, columns: np.ndarray, scores: np.ndarray) -> None:
        """Add scores of the items that pass."""
        floor = _floor(part.stop - part.start, self.k, self.of(part))
        high = np.flatnonzero(scores >= floor[rows] - 2 / RANK_SCALE)
        if len(high):
            new = rows[high], self.here[columns[high]], scores[high]
            self.put(part, *_first(part.stop - part.start, self.k, [self.of(part), new]))

    def meet(self, places: np.ndarray, item_ids: pa.Array) -> None:
        """The items that are scored next."""
        self.here = places
        self.passed.append((places, item_ids))

    def batches(self, first_ids: pa.Array | None = None) -> Iterator[pa.RecordBatch]:
        """(seed, item, score, rank); lists shorter than k are completed with ``first_ids`` of score 0."""
        met = np.concatenate([np.zeros(0, np.int64), *[places for places, _ in self.passed]])
        order = np.argsort(met)
        items = pa.concat_arrays([ids for _, ids in self.passed]) if self.passed else self.seed_ids.slice(0, 0)
        items, met = items.take(pa.array(order)), met[order]
        ids = pc.unique(self.seed_ids)
        if len(ids) < len(self.seed_ids):  # rows of one id share a list
            code = pc.index_in(self.seed_ids, value_set=ids).to_numpy(zero_copy_only=False)
            rows, places, scores = self.of(slice(0, len(code)))
            self.seed_ids, self.sizes = ids, self.sizes[: len(ids)]
            self.places, self.scores = self.places[: len(ids)], self.scores[: len(ids)]
            whole = slice(0, len(ids))
            self.put(whole, *_first(len(ids), self.k, [(code[rows], places, scores)]))
        step = max(1, EXACT_PAIRS // self.k)
        for start in range(0, len(self.seed_ids), step):
            part = slice(start, min(start + step, len(self.seed_ids)))
            rows, places, scores = self.of(part)
            found = items.take(pa.array(np.searchsorted(met, places)))
            rank = np.nonzero(np.arange(self.k) < self.sizes[part, None])[1] + 1
            if first_ids is not None:
                rows, found, scores, rank = self._completed(part, rows, found, scores, rank, first_ids)
            seeds = self.seed_ids.take(pa.array(rows + start))
            yield _batch(seeds, found, scores, rank.astype(np.int32), names=("seed", "item", "score", "rank"))

    def _completed(self, part: slice, rows: np.ndarray, found: pa.Array, scores: np.ndarray, rank: np.ndarray, first_ids: pa.Array):
        sizes = self.sizes[part]
        free = np.ones((len(sizes), len(first_ids)), bool)
        for of_row, ids in ((rows, found), (np.arange(len(sizes)), self.seed_ids[part])):
            used = pc.index_in(ids, value_set=first_ids).fill_null(-1).to_numpy(zero_copy_only=False)
            free[of_row[used >= 0], used[used >= 0]] = False
        number = np.cumsum(free, axis=1) + sizes[:, None]
        more, codes = np.nonzero(free & (number <= self.k))
        found = pa.concat_arrays([found, first_ids.take(pa.array(codes))])
        rows, scores = np.concatenate([rows, more]), np.concatenate([scores, np.zeros(len(more))])
        return rows, found, scores, np.concatenate([rank, number[more, codes]])


class Blend:
    """Scores of a slice by both cosines: ``scale`` * content + ``base``, and ``rise`` more where seed and item share
    listeners."""

    def __init__(self, content: tuple, collab: tuple, weight: float, rows: np.ndarray, columns: np.ndarray, values: np.ndarray):
        (self.low, high), (collab_low, collab_high) = content, collab
        self.weight, self.width = weight, high - self.low + MINMAX_EPSILON
        share = (1 - weight) / (collab_high - collab_low + MINMAX_EPSILON)
        self.scale, self.base = weight / self.width, -share * collab_low
        by_column = np.lexsort((rows, columns))
        self.rows, self.columns = rows[by_column], columns[by_column]
        self.rise = (values * share[rows])[by_column]

    def cosines(self, scores: np.ndarray) -> np.ndarray:
        """Cosines that pairs without shared listeners need, at least, for these scores."""
        with np.errstate(all="ignore"):
            least = (scores - 2 / RANK_SCALE - self.base) / self.scale + self.low
            slack = 1e-9 + 1e-12 * (np.abs(scores) + np.abs(self.base)) / self.scale
            return np.where(np.isfinite(least - slack), least - slack, -np.inf)

    def scores(self, cosines: np.ndarray) -> np.ndarray:
        """What pairs of these cosines score at least: no pair lies below the range of its shared listeners."""
        known = np.isfinite(cosines)
        return np.where(known, self.scale * (np.where(known, cosines, 0) - self.low) - 1e-6 * (1 + np.abs(self.base)), -np.inf)

    def _places(self, rows: np.ndarray, columns: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        n = len(self.scale)
        pairs, wanted = self.columns * n + self.rows, columns * n + rows
        at = np.minimum(np.searchsorted(pairs, wanted), max(len(pairs) - 1, 0))
        return at, pairs[at] == wanted if len(pairs) else np.zeros(len(rows), bool)

    def shares(self, rows: np.ndarray, columns: np.ndarray) -> np.ndarray:
        """Whether seed and item share listeners."""
        return self._places(rows, columns)[1]

    def exact(self, rows: np.ndarray, columns: np.ndarray, cosines: np.ndarray) -> np.ndarray:
        scores = self.weight * ((cosines - self.low[rows]) / self.width[rows]) + self.base[rows]
        at, shared = self._places(rows, columns)
        if len(self.rise):
            scores += np.where(shared, self.rise[at], 0.0)
        return scores


def _batch(*columns: pa.Array | np.ndarray, names: Sequence[str]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c) if isinstance(c, np.ndarray) else c for c in columns], names=list(names))


# ---- tiling --------------------------------------------------------------------------------------


def _block(column: Column, blocks: Column, seed: int) -> Column:
    return F.pmod(F.xxhash64(column, F.lit(seed)), blocks).cast("int")


def _all_blocks(blocks: Column) -> Column:
    return F.explode(F.sequence(F.lit(0), (blocks - 1).cast("int")))


class _Blocks:
    """How many blocks each side is cut into, as scalar subqueries."""

    def __init__(
        self, items: DataFrame, seeds: DataFrame, tile_items: int, tile_seeds: int, spread_seeds: bool = False
    ):
        tasks = 4 * items.sparkSession.sparkContext.defaultParallelism
        n_items = items.agg(F.count("*")).scalar()
        n_seeds = seeds.agg(F.count("*")).scalar()
        self.seeds = F.greatest(F.ceil(n_seeds / tile_seeds), F.lit(1))
        self.items = F.greatest(F.ceil(n_items / tile_items), F.lit(1))
        # enough tiles to occupy the cluster even where one tile could hold everything; a seed has a list per block of
        # items, so cutting the seeds instead returns fewer rows
        if spread_seeds:
            self.seeds = F.greatest(self.seeds, F.least(F.ceil(n_seeds / SLICE_ROWS), F.ceil(F.lit(tasks) / self.items)))
        else:
            self.items = F.greatest(self.items, F.least(F.ceil(n_items / SLICE_ROWS), F.ceil(F.lit(tasks) / self.seeds)))


def per_tile(
    left: DataFrame,
    right: DataFrame,
    function: Callable[[pa.Table, pa.Table], Iterator[pa.RecordBatch]],
    schema: T.StructType,
    tile: Sequence[str] = ("item_block", "seed_block"),
) -> DataFrame:
    """Apply ``function`` to each pair of blocks.

    After the columns of ``tile`` both sides have the same columns, but for their names. What ``function`` yields
    leaves the task batch by batch, so results need not fit in it.
    """
    names = [[c for c in side.columns if c not in tile] for side in (left, right)]
    sides = left.select(*tile, *names[0], F.lit(False).alias("_right")).union(
        right.select(*tile, *names[1], F.lit(True).alias("_right"))
    )

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = ([], [])
        for batch in batches:
            is_right = batch.column("_right")
            rows = batch.select(names[0])
            found[0].append(rows.filter(pc.invert(is_right)))
            found[1].append(rows.filter(is_right).rename_columns(names[1]))
        tables = [pa.Table.from_batches(part) for part in found]
        del found
        if tables[0].num_rows and tables[1].num_rows:
            yield from function(*tables)

    return sides.groupBy(*tile).applyInArrow(apply, schema)


def _stream(rows: pa.Table | pa.RecordBatch) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, rows.schema) as writer:
        writer.write(rows)
    return sink.getvalue().to_pybytes()


def _whole_items(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Tables of about ``PACKED_ROWS`` rows or ``PACKED_PLAYS`` plays of batches sorted by item; rows of one item stay together."""
    held = []
    for batch in batches:
        shares = np.full(batch.num_rows, 1 / PACKED_ROWS)
        if "users" in batch.schema.names:
            shares += pc.list_value_length(batch.column("users")).to_numpy(zero_copy_only=False) / PACKED_PLAYS
        starts = np.flatnonzero(np.diff(np.floor(np.cumsum(shares) - shares), prepend=-1)).tolist()
        for start, stop in zip(starts, [*starts[1:], batch.num_rows]):
            some = batch.slice(start, stop - start)
            if held:
                ids, last = some.column("item"), held[-1].column("item")[-1]
                same = pc.equal(ids, last).fill_null(False) if last.is_valid else pc.is_null(ids)
                other = np.flatnonzero(~same.to_numpy(zero_copy_only=False))
                cut = int(other[0]) if len(other) else some.num_rows
                held.append(some.slice(0, cut))
                some = some.slice(cut)
                if not some.num_rows:
                    continue
                yield pa.Table.from_batches(held).combine_chunks()
            held = [some]
    if held:
        yield pa.Table.from_batches(held).combine_chunks()


def _packed_items(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for table in _whole_items(batches):
        yield pa.RecordBatch.from_arrays([pa.array([_stream(table)], pa.binary())], names=["data"])


def _packed_seeds(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of a block's seeds, and one without seeds after them."""
    names, some = ["seeds", "has_seeds"], False
    for batch in batches:
        if batch.num_rows:
            some = True
            yield pa.RecordBatch.from_arrays([pa.array([_stream(batch)], pa.binary()), pa.array([True])], names=names)
    if some:
        yield pa.RecordBatch.from_arrays([pa.array([None], pa.binary()), pa.array([False])], names=names)


def _unpacked(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[bool, pa.Table]]:
    for batch in batches:
        for has_seeds, data in zip(batch.column("has_seeds").to_pylist(), batch.column("data")):
            if data.is_valid:
                yield has_seeds, pa.ipc.open_stream(data.as_buffer()).read_all()


class _Pass(NamedTuple):
    """Blocks of seeds, and of items where there are too few seeds to occupy the cluster; ranges in which items are stored."""

    seeds: int
    items: int
    ranges: int

    @classmethod
    def of(cls, spark, n_items: int, n_seeds: int, block_seeds: int, least_items: int) -> _Pass:
        tasks = 2 * spark.sparkContext.defaultParallelism
        seeds = max(1, math.ceil(n_seeds / block_seeds), min(math.ceil(n_seeds / SLICE_ROWS), tasks))
        items = 1 if 2 * seeds > tasks else max(1, min(math.ceil(n_items / least_items), tasks // seeds))
        ranges = max(1, items, min(math.ceil(n_items / PACKED_ROWS), tasks), math.ceil(n_items / RANGE_ROWS))
        return cls(seeds, items, ranges)

    def over(
        self,
        items: DataFrame,
        seeds: DataFrame,
        function: Callable[[pa.Table, Iterator[pa.Table]], Iterator[pa.RecordBatch]],
        schema: T.StructType,
        block: Column | None = None,
    ) -> DataFrame:
        """What ``function`` yields: it gets a block's seeds and then its items, as tables that hold all rows of an item, with
        their ``place`` in the order of the ids. The seeds' ``block`` is drawn by hash if none is given.

        The first row that a task reads of the items is joined with the packed seeds, all others with one row that has none.
        """
        placed = items.repartitionByRange(self.ranges, "item").sortWithinPartitions("item")
        placed = placed.withColumn("place", F.monotonically_increasing_id())
        # rows are large: without these a row group has a hundred of them at least
        options = {"parquet.block.size": str(1 << 24), "parquet.page.size.row.check.min": "8"}
        stored = materialise(placed.mapInArrow(_packed_items, "data binary"), "passing-items", **options)
        no_item = items.sparkSession.range(0, 1, 1, 1).select(F.lit(None).cast("binary").alias("data"))
        passing = no_item.union(stored).coalesce(self.items)
        passing = passing.withColumn("is_first", F.pmod(F.monotonically_increasing_id(), F.lit(1 << 33)) == 0)
        block = _block(F.col("seed"), F.lit(self.seeds), 2) if block is None else block
        held = seeds.repartitionById(self.seeds, block).mapInArrow(_packed_seeds, "seeds binary, has_seeds boolean")
        met = passing.hint("shuffle_replicate_nl").join(held, F.col("is_first") | ~F.col("has_seeds"))

        def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            tables, of_block, rest = _unpacked(batches), [], []
            for has_seeds, table in tables:
                if not has_seeds:
                    rest = [table]
                    break
                of_block.append(table)
            if of_block:
                yield from function(pa.concat_tables(of_block), chain(rest, (table for _, table in tables)))

        return met.select("has_seeds", F.coalesce("seeds", "data").alias("data")).mapInArrow(apply, schema)

    def lists(
        self,
        items: DataFrame,
        seeds: DataFrame,
        function: Callable[[pa.Table, Iterator[pa.Table]], Lists],
        k: int,
        first_ids: pa.Array | None = None,
        block: Column | None = None,
        whole: bool = True,
    ) -> DataFrame:
        """(seed, item, score, rank) of the ``Lists`` that ``function`` gives; those of a seed are merged where its rows are not
        ``whole`` in a block."""
        fields = [_id_field(seeds, "seed"), _id_field(items, "item"), T.StructField("score", T.DoubleType())]
        schema = T.StructType([*fields, T.StructField("rank", T.IntegerType())])
        completed = first_ids if self.items == 1 else None

        def best(held: pa.Table, passing: Iterator[pa.Table]) -> Iterator[pa.RecordBatch]:
            yield from function(held, passing).batches(completed)

        lists = self.over(items, seeds, best, schema, block)
        return lists if self.items == 1 and whole else top_k(lists.drop("rank"), k)


def _some(tables: Iterator[pa.Table], share: Callable[[pa.Table], float]) -> Iterator[pa.Table]:
    """Tables whose parts' shares reach 1, in the order of the places."""

    def joined() -> pa.Table:
        return pa.concat_tables(sorted(held, key=lambda table: table["place"][0].as_py())).combine_chunks()

    held, size = [], 0.0
    for table in tables:
        held.append(table)
        size += share(table)
        if size >= 1:
            ready, held, size = [joined()], [], 0.0
            del table
            yield ready.pop()  # nothing of it stays here
    if held:
        yield joined()


class _Likes(NamedTuple):
    """Blocks of seeds by their categories, so that a task holds like ones, and with them the items of its block: their scores
    say early what the lists will reach. Borders are drawn from some seeds; they decide which task does what, and no result."""

    columns: list[int]
    borders: list[str]
    whole: bool = True  # no id has two rows, which may lie in two blocks

    @classmethod
    def of(cls, seeds: DataFrame, blocks: _Pass, n_items: int, tile_rows: int) -> _Likes | None:
        """None where the items of a block are too many to be held, or nothing is cut."""
        if blocks.items > 1 or blocks.seeds == 1 or n_items > blocks.seeds * tile_rows:
            return None
        n, ids = seeds.agg(F.count("*"), F.count_distinct(F.struct("seed"))).first()
        drawn = min(MOST_DRAWN, DRAWN_SEEDS * blocks.seeds)
        rows = seeds.select("seed", "cats").orderBy(F.xxhash64("seed", F.lit(17)), "seed").limit(drawn).select("cats").collect()
        found = [row.cats or [] for row in rows]
        width = min((len(cats) for cats in found), default=0)
        columns = sorted(range(width), key=lambda c: len({cats[c] for cats in found}))
        keys = sorted(row.key for row in seeds.sparkSession.createDataFrame(
            [(i, cats) for i, cats in enumerate(found)], "seed long, cats array<string>"
        ).select(cls(columns, []).key("seed").alias("key")).collect())
        return cls(columns, [keys[len(keys) * b // blocks.seeds] for b in range(1, blocks.seeds)] if keys else [], n == ids)

    def key(self, column: str) -> Column:
        values = [F.coalesce(F.get("cats", F.lit(c)), F.lit("")) for c in self.columns]
        return F.concat_ws("\u0001", *values, F.lpad(F.hex(F.xxhash64(column, F.lit(2))), 16, "0"))

    def block(self, column: str) -> Column:
        key = self.key(column)
        return F.size(F.filter(F.array(*map(F.lit, self.borders)).cast("array<string>"), lambda border: border <= key))


def _reached(home: pa.Table, tile_seeds: pa.Table, k: int) -> np.ndarray:
    """For each seed the k-th best cosine among some items, itself left out; -inf if they are fewer."""
    if not home.num_rows:
        return np.full(tile_seeds.num_rows, -np.inf)
    tile = Tile(home.select(["seed", "dense", "cats"]).rename_columns(["item", "dense", "cats"]), tile_seeds)
    # one row of a seed's id is left out; there may be more of them
    wanted = k - 1 + max(pc.value_counts(tile.item_ids).field("counts").to_pylist())
    floors = [_floor(part.stop - part.start, wanted, tile.best(part, wanted)) for part in tile.parts()]
    return np.concatenate(floors)


def _alone(seeds: pa.Table) -> Tile:
    return Tile(seeds.slice(0, 1).select(["seed", "dense", "cats"]).rename_columns(["item", "dense", "cats"]), seeds)


def _in_order(seeds: pa.Table) -> pa.Table:
    """Seeds in the order of their categories and lengths, so that a slice holds like ones."""
    tile = _alone(seeds)
    return seeds.take(pa.array(_by_categories(tile.seed_codes, tile.seed_lengths)))


def _with_home(items: DataFrame, seeds: DataFrame, likes: _Likes | None) -> DataFrame:
    """Seeds and, if blocks hold like ones, the items of their blocks."""
    held = seeds.withColumn("is_seed", F.lit(True))
    return held if likes is None else held.union(items.withColumn("is_seed", F.lit(False)))


def _seeds_and_home(held: pa.Table) -> tuple[pa.Table, pa.Table]:
    return held.filter(held["is_seed"]), held.filter(pc.invert(held["is_seed"]))


def _id_field(df: DataFrame, column: str) -> T.StructField:
    return T.StructField(column, df.schema[column].dataType)


def as_items(features: DataFrame, key: str = "track_id") -> DataFrame:
    return features.select(F.col(key).alias("item"), "dense", "cats")


def as_seeds(features: DataFrame, key: str = "track_id") -> DataFrame:
    return features.select(F.col(key).alias("seed"), "dense", "cats")


# ---- content -------------------------------------------------------------------------------------


def best_of_tile(k: int) -> Callable[[pa.Table, pa.Table], Iterator[pa.RecordBatch]]:
    """Of a tile's items and seeds, the k best items of each seed (seed, item, score)."""

    def best(left: pa.Table, right: pa.Table) -> Iterator[pa.RecordBatch]:
        tile = Tile(left.sort_by("item"), right)
        for part in tile.parts():
            rows, columns, scores = tile.best(part, k)
            ids = tile.seed_ids.take(pa.array(rows + part.start))
            yield _batch(ids, tile.item_ids.take(pa.array(columns)), scores, names=("seed", "item", "score"))

    return best


def content_top_k(items: DataFrame, seeds: DataFrame, k: int, tile_rows: int = TILE_ROWS) -> DataFrame:
    """(seed, item, score, rank) of the k items with the highest cosine, the seed itself left out.

    Both sides are feature rows: (item, dense, cats) and (seed, dense, cats).
    """
    n_items = items.count()
    blocks = _Pass.of(items.sparkSession, n_items, seeds.count(), tile_rows, SLICE_ROWS)
    items, seeds = items.select("item", "dense", "cats"), seeds.select("seed", "dense", "cats")
    likes = _Likes.of(seeds, blocks, n_items, tile_rows)

    def best(held: pa.Table, passing: Iterator[pa.Table]) -> Lists:
        held, home = _seeds_and_home(held)
        lists = Lists(_array(held["seed"]), max(1, min(k, n_items)))
        if not held.num_rows:
            return lists
        held = _in_order(held.select(["seed", "dense", "cats"]))
        lists = Lists(_array(held["seed"]), lists.k)
        lists.floors = _reached(home, held, lists.k)
        for some in _some(passing, lambda table: table.num_rows / tile_rows):
            tile = Tile(some, held)
            lists.meet(some["place"].to_numpy(), tile.item_ids)
            for part in tile.parts():
                lists.put(part, *tile.best(part, lists.k, lists=lists))
            del some, tile
        return lists

    held = _with_home(items, seeds, likes)
    if likes is None:
        return blocks.lists(items, held, best, k)
    return blocks.lists(items, held, best, k, block=likes.block("seed"), whole=likes.whole)


def content_ranges(items: DataFrame, seeds: DataFrame, tile_rows: int = TILE_ROWS) -> DataFrame:
    """(seed, low, high) of each seed's cosines over all items, the seed itself included."""
    n_items = items.count()
    blocks = _Pass.of(items.sparkSession, n_items, seeds.count(), tile_rows, SLICE_ROWS)
    items, seeds = items.select("item", "dense", "cats"), seeds.select("seed", "dense", "cats")
    likes = _Likes.of(seeds, blocks, n_items, tile_rows)
    schema = T.StructType(
        [_id_field(seeds, "seed"), T.StructField("low", T.DoubleType()), T.StructField("high", T.DoubleType())]
    )

    def range_of(held: pa.Table, passing: Iterator[pa.Table]) -> Iterator[pa.RecordBatch]:
        held, home = _seeds_and_home(held)
        if not held.num_rows:
            return
        held = _in_order(held)
        seeds = _alone(held)
        by_likeness = np.concatenate(_by_likeness(seeds.seeds / seeds.seed_norms[:, None], SLICE_ROWS))
        far_held = held.take(pa.array(by_likeness))
        low, high = np.full(held.num_rows, np.inf), np.full(held.num_rows, -np.inf)
        del seeds
        if home.num_rows:
            tile = Tile(home.select(["seed", "dense", "cats"]).rename_columns(["item", "dense", "cats"]), held)
            for part in tile.parts():
                tile.highest(part, high[part])
        for some in _some(passing, lambda table: table.num_rows / tile_rows):
            tile = Tile(some, held)
            for part in tile.parts():
                tile.highest(part, high[part])
            del tile
            tile = FarTile(some, far_held)
            for start in range(0, len(low), SLICE_ROWS):
                tile.lowest(slice(start, min(start + SLICE_ROWS, len(low))), low[start : start + SLICE_ROWS])
            del some, tile
        if low[0] <= high[0]:
            ends = np.empty(len(low))
            ends[by_likeness] = low
            yield _batch(_array(held["seed"]), ends, high, names=("seed", "low", "high"))

    block = None if likes is None else likes.block("seed")
    tiles = blocks.over(items, _with_home(items, seeds, likes), range_of, schema, block)
    return tiles.groupBy("seed").agg(F.min("low").alias("low"), F.max("high").alias("high"))


# ---- collaborative -------------------------------------------------------------------------------

# plays of a block of seeds, and of the items that pass it at a time
TILE_PLAYS = 2_000_000
PASSING_PLAYS = 2_000_000
# seeds whose lists are merged at once
MERGED_SEEDS = 8192
# pairs of a seed's play and an item's play that are added up at once
SLICE_PAIRS = 500_000
# Users with more items of a tile than this, and than a share of them, are multiplied as a dense matrix.
HEAVY_ITEMS = 256
DENSE_SHARE = 1 / 16
DENSE_USERS = 1024


def item_norms(interactions: DataFrame) -> DataFrame:
    return interactions.groupBy("track_id").agg(
        F.sqrt(F.sum(F.col("playcount") * F.col("playcount"))).alias("norm")
    )


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (id, user, plays) sorted by id, as one row of arrays per id and batch."""
    for batch in batches:
        if batch.num_rows:
            ids, users, plays = batch.columns
            first = np.concatenate([[True], pc.not_equal(ids[1:], ids[:-1]).to_numpy(zero_copy_only=False)])
            starts = np.flatnonzero(first)
            offsets = pa.array(np.append(starts, len(ids)).astype(np.int32))
            yield pa.RecordBatch.from_arrays(
                [ids.take(pa.array(starts)), pa.ListArray.from_arrays(offsets, users), pa.ListArray.from_arrays(offsets, plays)],
                names=["item", "users", "plays"],
            )


def _profiles(interactions: DataFrame) -> DataFrame:
    """(item, users, plays): the plays of an item as arrays, which travel in a third of the bytes. No array is longer than an
    Arrow batch; an item with more plays has several rows."""
    entries = interactions.filter(
        (F.col("playcount") != 0) & F.col("track_id").isNotNull() & F.col("user_id").isNotNull()
    ).select(F.col("track_id").alias("item"), "user_id", F.col("playcount").cast("double").alias("playcount"))
    schema = T.StructType(
        [
            entries.schema["item"],
            T.StructField("users", T.ArrayType(entries.schema["user_id"].dataType)),
            T.StructField("plays", T.ArrayType(T.DoubleType())),
        ]
    )
    return entries.repartition("item").sortWithinPartitions("item").mapInArrow(_packed, schema)


class _Plays:
    """The plays of one side of a tile: codes of the ids, users, and plays, scaled to unit vectors if asked."""

    def __init__(self, table: pa.Table, key: str, scaled: bool, ids: pa.Array | None = None):
        rows, users, plays = (_array(table[name]) for name in (key, "users", "plays"))
        if ids is None:
            ids = pc.unique(rows)
            ids = ids.take(pc.sort_indices(ids))
        codes = pc.index_in(rows, value_set=ids).fill_null(-1).to_numpy(zero_copy_only=False).astype(np.int32)
        lengths = pc.list_value_length(users).to_numpy(zero_copy_only=False)
        self.ids, self.codes = ids, np.repeat(codes, lengths)
        self.users, self.plays = users.flatten(), plays.flatten().to_numpy(zero_copy_only=False)
        if "place" in table.column_names:
            first = pc.index_in(ids, value_set=rows)
            self.places = _array(table["place"]).take(first).to_numpy(zero_copy_only=False)
        if scaled:
            known = self.codes >= 0
            squares = np.bincount(self.codes[known], self.plays[known] ** 2, minlength=len(ids))
            norms = np.append(np.sqrt(squares), 1.0)[self.codes]
            self.plays = np.divide(self.plays, norms, out=norms)

    def at(self, users: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Codes, places in ``users`` and plays of the rows of these users."""
        place = pc.index_in(self.users, value_set=users).fill_null(-1).to_numpy(zero_copy_only=False)
        common = (place >= 0) & (self.codes >= 0)
        if common.all():
            return self.codes, place, self.plays
        return self.codes[common], place[common], self.plays[common]

    @cached_property
    def by_code(self) -> tuple[pa.Array, np.ndarray, np.ndarray, np.ndarray]:
        """All users; of the plays in the order of the codes, places among them, plays, and where each code begins. The plays
        are kept in this order alone."""
        users = pc.unique(self.users)
        codes, place, plays = self.at(users)
        self.users = self.codes = self.plays = None
        order = np.argsort(codes, kind="stable")
        bounds = np.append(0, np.cumsum(np.bincount(codes, minlength=len(self.ids))))
        return users, place[order], plays[order], bounds


def _added_up(keys: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(keys)
    keys = keys[order]
    starts = np.flatnonzero(np.diff(keys, prepend=-1))
    return keys[starts], np.add.reduceat(values[order], starts) if len(starts) else values[:0]


class _Products:
    """Products of the profiles of a tile's seeds and items, for ranges of seeds."""

    def __init__(self, items: _Plays, seeds: _Plays, heavy_items: int):
        self.n_items, self.n_seeds = len(items.ids), len(seeds.ids)
        users, self.seed_users, self.seed_plays, self.bounds = seeds.by_code
        codes, place, plays = items.at(users)
        by_user = np.argsort(place, kind="stable")
        self.items, self.item_plays = codes[by_user], plays[by_user]
        sizes = np.bincount(place, minlength=len(users))
        del codes, place, plays, by_user
        self.starts = np.cumsum(sizes) - sizes
        heavy = sizes > max(heavy_items, self.n_items * DENSE_SHARE)
        self.dense_users = np.flatnonzero(heavy)
        self.sizes = sizes
        # of each seed's plays, how many pairs they make
        self.pairs = np.where(heavy, 0, sizes)[self.seed_users]
        self.is_dense = heavy[self.seed_users]

    def ranges(self, most: int | None = None, cuts: np.ndarray | None = None) -> Iterator[slice]:
        """Ranges of seeds of a bounded number of pairs, of ``most`` seeds, and over none of the ``cuts``."""
        total = np.concatenate([[0], np.cumsum(self.pairs)])[self.bounds]
        dense = np.concatenate([[0], np.cumsum(self.is_dense)])[self.bounds]
        total = total + np.concatenate([[0], np.cumsum(np.diff(dense) > 0)]) * self.n_items
        start = 0
        while start < self.n_seeds:
            stop = int(np.searchsorted(total, total[start] + SLICE_PAIRS, "right")) - 1
            stop = min(max(stop, start + 1), self.n_seeds, start + (most or self.n_seeds))
            if cuts is not None:
                stop = min([stop, *cuts[np.searchsorted(cuts, start, "right") :][:1].tolist()])
            yield slice(start, stop)
            start = stop

    def of(self, part: slice) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Row, column and product of the pairs that share a user, in order; rows count from the part's start."""
        first, last = self.bounds[part.start], self.bounds[part.stop]
        seed = np.repeat(np.arange(part.stop - part.start), np.diff(self.bounds[part.start : part.stop + 1]))
        ends = np.cumsum(self.pairs[first:last])
        keys, values = [], []
        at = 0
        while at < len(seed):
            before = ends[at - 1] if at else 0
            to = max(at + 1, int(np.searchsorted(ends, before + 2 * SLICE_PAIRS, "right")))
            some, counts = slice(first + at, first + to), self.pairs[first + at : first + to]
            offset = np.repeat(self.starts[self.seed_users[some]] - (ends[at:to] - counts - before), counts)
            entry = offset + np.arange(len(offset))
            key = np.repeat(seed[at:to], counts) * self.n_items + self.items[entry]
            added = _added_up(key, np.repeat(self.seed_plays[some], counts) * self.item_plays[entry])
            keys.append(added[0])
            values.append(added[1])
            at = to
        for key, value in self._dense(part, seed, first):
            keys.append(key)
            values.append(value)
        if not keys:
            return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)
        found = (keys[0], values[0]) if len(keys) == 1 else _added_up(np.concatenate(keys), np.concatenate(values))
        return *np.divmod(found[0], self.n_items), found[1]

    def _dense(self, part: slice, seed: np.ndarray, first: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        mine = np.flatnonzero(self.is_dense[first : first + len(seed)])
        if not len(mine):
            return
        rows, at_row = np.unique(seed[mine], return_inverse=True)
        users = np.searchsorted(self.dense_users, self.seed_users[first + mine])
        plays = self.seed_plays[first + mine]
        for row in range(0, len(rows), SLICE_ROWS):
            height = min(SLICE_ROWS, len(rows) - row)
            total = np.zeros((height, self.n_items))
            for user in range(0, len(self.dense_users), DENSE_USERS):
                some = self.dense_users[user : user + DENSE_USERS]
                here = (at_row >= row) & (at_row < row + height) & (users >= user) & (users < user + len(some))
                cells = (at_row[here] - row) * len(some) + users[here] - user
                left = np.bincount(cells, plays[here], height * len(some)).reshape(height, len(some))
                entry = np.concatenate([np.arange(self.starts[u], self.starts[u] + self.sizes[u]) for u in some])
                of_user = np.repeat(np.arange(len(some)), self.sizes[some])
                by_item = np.argsort(self.items[entry], kind="stable")
                entry, of_user = entry[by_item], of_user[by_item]
                edges = np.searchsorted(self.items[entry], np.arange(0, self.n_items + CHUNK_ITEMS, CHUNK_ITEMS))
                for chunk, start in enumerate(range(0, self.n_items, CHUNK_ITEMS)):
                    width = min(CHUNK_ITEMS, self.n_items - start)
                    inside = slice(edges[chunk], edges[chunk + 1])
                    cells = of_user[inside] * width + self.items[entry[inside]] - start
                    right = np.bincount(cells, self.item_plays[entry[inside]], len(some) * width)
                    total[:, start : start + width] += left @ right.reshape(len(some), width)
            found, columns = np.nonzero(total)
            yield rows[row + found] * self.n_items + columns, total[found, columns]


def _plays_share(table: pa.Table) -> float:
    return (pc.sum(pc.list_value_length(table["users"])).as_py() or 0) / PASSING_PLAYS


def _collab_tiles(
    interactions: DataFrame,
    seeds: DataFrame,
    heavy_items: int,
    scaled: bool,
    ranges: DataFrame | None = None,
) -> DataFrame:
    """(seed, item, dot) of the products of each block of seeds, all users of an item and of a seed in them."""
    wanted = seeds.select(F.col("track_id").alias("item")).distinct()
    played = interactions.filter("playcount != 0")
    asked = played.join(wanted.withColumnRenamed("item", "track_id"), "track_id", "left_semi")
    blocks = _Pass.of(interactions.sparkSession, played.count(), asked.count(), TILE_PLAYS, TILE_PLAYS)
    profiles = _profiles(interactions)
    ends = T.DoubleType()
    sought = profiles.join(wanted, "item", "left_semi")
    if ranges is not None:
        of_seed = ranges.select(F.col("seed").alias("item"), F.col("low").cast(ends), F.col("high").cast(ends))
        sought = sought.join(of_seed, "item")
    else:
        sought = sought.withColumns({"low": F.lit(0.0), "high": F.lit(0.0)})
    normalised = ranges is not None
    sought = sought.withColumnRenamed("item", "seed").select("seed", "users", "plays", "low", "high")
    schema = T.StructType(
        [
            T.StructField("seed", profiles.schema["item"].dataType),
            profiles.schema["item"],
            T.StructField("dot", T.DoubleType()),
        ]
    )

    def product(held: pa.Table, passing: Iterator[pa.Table]) -> Iterator[pa.RecordBatch]:
        seeds = _Plays(held, "seed", scaled)
        low, high = np.zeros(len(seeds.ids)), np.ones(len(seeds.ids))
        if normalised:
            at = pc.index_in(_array(held["seed"]), value_set=seeds.ids).to_numpy(zero_copy_only=False)
            low[at], high[at] = held["low"].to_numpy(), held["high"].to_numpy()
        for some in _some(passing, _plays_share):
            items = _Plays(some, "item", scaled)
            products = _Products(items, seeds, heavy_items)
            for part in products.ranges():
                rows, columns, values = products.of(part)
                if normalised:
                    values = (values - low[part][rows]) / (high[part][rows] - low[part][rows] + MINMAX_EPSILON)
                seed_ids = seeds.ids.take(pa.array(rows + part.start))
                item_ids = items.ids.take(pa.array(columns))
                yield _batch(seed_ids, item_ids, values, names=("seed", "item", "dot"))
            del some, items, products

    return blocks.over(profiles, sought, product, schema)


def collab_products(interactions: DataFrame, seeds: DataFrame, heavy_items: int = HEAVY_ITEMS) -> DataFrame:
    """(seed, item, dot): products of the user profiles, for items sharing a user with the seed.

    ``interactions`` has one row per (track, user); ``seeds`` is a table of ``track_id``. A task holds all plays of its
    seeds and of the items that pass, so its sums are final and no pair is shuffled. Users with very many items are multiplied as
    a matrix.
    """
    return _collab_tiles(interactions, seeds, heavy_items, scaled=False)


def collab_scores(
    interactions: DataFrame, seeds: DataFrame, heavy_items: int = HEAVY_ITEMS, ranges: DataFrame | None = None
) -> DataFrame:
    """(seed, item, score): cosine of the user profiles, the seed's own row included.

    Plays are divided by the norm of their track first, so the products are the scores. With ``ranges`` (seed, low, high)
    scores are min-max normalised.
    """
    return _collab_tiles(interactions, seeds, heavy_items, scaled=True, ranges=ranges).withColumnRenamed("dot", "score")


def collab_top_k(
    interactions: DataFrame, seeds: DataFrame, k: int, fill_zero: bool = True, heavy_items: int = HEAVY_ITEMS
) -> DataFrame:
    """(seed, item, score, rank) of the k items with the highest cosine, the seed itself left out.

    A task holds the plays of its seeds while those of all items pass by. ``fill_zero`` completes lists shorter than k with
    tracks of score 0, by id. A seed short of k has fewer than k items to avoid, so the first 2k+1 ids of the log always
    hold enough.
    """
    listed = seeds.select("track_id").distinct()
    in_log = interactions.select("track_id").distinct()
    profiles = _profiles(interactions)
    played = interactions.filter("playcount != 0")
    asked = played.join(listed, "track_id", "left_semi")
    blocks = _Pass.of(interactions.sparkSession, played.count(), asked.count(), TILE_PLAYS, TILE_PLAYS)
    sought = profiles.join(listed.withColumnRenamed("track_id", "item"), "item", "left_semi").withColumnRenamed("item", "seed")
    first_ids = None
    if fill_zero:
        first_ids = in_log.filter("track_id is not null").orderBy("track_id").limit(2 * k + 1).toArrow()["track_id"]
        if blocks.items == 1:
            # known seeds without plays have a list, too
            no_plays = [F.array().cast(profiles.schema[c].dataType).alias(c) for c in ("users", "plays")]
            known = listed.join(in_log, "track_id", "left_semi").select(F.col("track_id").alias("seed"), *no_plays)
            sought = sought.union(known)

    def best(held: pa.Table, passing: Iterator[pa.Table]) -> Lists:
        seeds = _Plays(held, "seed", True)
        lists = Lists(seeds.ids, k)
        for some in _some(passing, _plays_share):
            items = _Plays(some, "item", True)
            lists.meet(items.places, items.ids)
            products = _Products(items, seeds, heavy_items)
            own = pc.index_in(seeds.ids, value_set=items.ids).fill_null(-1).to_numpy(zero_copy_only=False)
            for part in products.ranges(MERGED_SEEDS):
                rows, columns, values = products.of(part)
                other = np.flatnonzero(columns != own[part][rows])
                lists.add(part, rows[other], columns[other], values[other])
            del some, items, products, own
        return lists

    lists = blocks.lists(profiles, sought, best, k, first_ids if first_ids is None else _array(first_ids))
    if blocks.items == 1 or not fill_zero:
        return lists
    first_ids = in_log.orderBy("track_id").limit(2 * k + 1).agg(F.array_sort(F.collect_list("track_id"))).scalar()
    known = listed.join(in_log, "track_id", "left_semi").select(F.col("track_id").alias("seed"))
    # a list holds at most k entries, and there are few
    lists = lists.groupBy("seed").agg(F.collect_list(F.struct("rank", "item", "score")).alias("found"))
    unused = F.array_except("first_ids", F.array_append(F.col("found")["item"], F.col("seed")))
    missing = F.transform(
        F.slice(unused, F.lit(1), F.lit(k) - F.size("found")),
        lambda item, i: F.struct(
            (F.size("found") + i + 1).alias("rank"), item.alias("item"), F.lit(0.0).alias("score")
        ),
    )
    return (
        known.join(lists, "seed", "left")
        .withColumns({"found": F.coalesce("found", F.array()), "first_ids": first_ids})
        .withColumn("list", F.when(F.size("found") < k, F.concat("found", missing)).otherwise(F.col("found")))
        .select("seed", F.inline("list"))
        .select("seed", "item", "score", "rank")
    )


# ---- hybrid --------------------------------------------------------------------------------------


def collab_ranges(scores: DataFrame, n_items: Column) -> DataFrame:
    """(seed, low, high) of each seed's collaborative scores over ``n_items`` items, where pairs that are
    not listed score 0."""
    listed = scores.groupBy("seed").agg(
        F.min("score").alias("low"), F.max("score").alias("high"), F.count("*").alias("n")
    )
    partial = F.col("n") < n_items
    return listed.select(
        "seed",
        F.when(partial, F.least("low", F.lit(0.0))).otherwise(F.col("low")).alias("low"),
        F.when(partial, F.greatest("high", F.lit(0.0))).otherwise(F.col("high")).alias("high"),
    )


def hybrid_top_k(
    items: DataFrame, seeds: DataFrame, interactions: DataFrame, k: int, weight_content: float, heavy_items: int = HEAVY_ITEMS
) -> DataFrame:
    """(seed, item, score, rank) by the weighted sum of the two min-max normalised cosines.

    ``items`` and ``seeds`` are feature rows of the same universe, ``interactions`` the log inside it. Pairs that share no
    user have a collaborative score of 0. The ranges of both cosines come first, as a few numbers per seed; with them
    a tile, which holds the vectors and the plays of its items and seeds, returns its k best items per seed.
    """
    listed = seeds.select(F.col("seed").alias("track_id"))
    n_items = items.agg(F.count("*")).scalar()
    ranges = {
        "content": content_ranges(items, seeds),
        "collab": collab_ranges(collab_scores(interactions, listed, heavy_items), n_items),
    }
    ends, names = [], list(ranges)
    ranged = seeds
    for name, of_seed in ranges.items():
        ends += [f"{name}_low", f"{name}_high"]
        renamed = of_seed.select(F.col("seed").alias("__seed"), F.col("low").alias(ends[-2]), F.col("high").alias(ends[-1]))
        ranged = ranged.join(renamed, F.col("seed") == F.col("__seed"), "left").drop("__seed")
    ranged = ranged.na.fill(0.0, ends)
    profiles = _profiles(interactions)
    n_items = items.count()
    blocks = _Pass.of(items.sparkSession, n_items, seeds.count(), TILE_ROWS, SLICE_ROWS)
    likes = _Likes.of(seeds, blocks, n_items, TILE_ROWS)
    block = _block(F.col("seed"), F.lit(blocks.seeds), 2) if likes is None else likes.block("seed")
    of_seed = seeds.select(F.col("seed").alias("item"), block.alias("block")).distinct()
    sought = profiles.join(of_seed, "item").withColumnRenamed("item", "seed")
    vector, plays = [items.schema[c].dataType for c in ("dense", "cats")], [profiles.schema[c].dataType for c in ("users", "plays")]
    # vectors and plays are rows of their own; empty rather than null: writing runs of null lists to Arrow takes quadratic time
    no_vector = [F.array().cast(t).alias(c) for c, t in zip(("dense", "cats"), vector)]
    no_plays = [F.array().cast(t).alias(c) for c, t in zip(("users", "plays"), plays)]
    no_ends = [F.lit(0.0).alias(c) for c in ends]
    passing = items.select("item", "dense", "cats", *no_plays).unionByName(
        profiles.select("item", *no_vector, "users", "plays")
    )
    vectors = ranged.withColumn("is_seed", F.lit(True))
    if likes is not None:
        home = items.select(F.col("item").alias("seed"), "dense", "cats", *no_ends, F.lit(False).alias("is_seed"))
        vectors = vectors.unionByName(home)
    held = vectors.select("seed", "dense", "cats", *no_plays, *ends, "is_seed", block.alias("block")).unionByName(
        sought.select("seed", *no_vector, "users", "plays", *no_ends, F.lit(True).alias("is_seed"), "block")
    )

    def share(table: pa.Table) -> float:
        return max(table.num_rows / TILE_ROWS, _plays_share(table))

    def best(held: pa.Table, passing: Iterator[pa.Table]) -> Lists:
        def parted(table: pa.Table) -> tuple[pa.Table, pa.Table]:
            is_vector = pc.equal(pc.list_value_length(table["users"]), 0)
            return table.filter(is_vector), table.filter(pc.invert(is_vector))

        held, home = _seeds_and_home(held)
        seed_rows, seed_plays = parted(held)
        if seed_rows.num_rows:
            seed_rows = _in_order(seed_rows)
        lists = Lists(_array(seed_rows["seed"]), k)
        if not seed_rows.num_rows:
            return lists
        reached = _reached(home, seed_rows, k)
        of_seeds = _Plays(seed_plays, "seed", True, lists.seed_ids)
        content, collab = ([seed_rows[f"{name}_{end}"].to_numpy() for end in ("low", "high")] for name in names)
        for some in _some(passing, share):
            item_rows, item_plays = parted(some)
            if not item_rows.num_rows:
                continue
            tile = Tile(item_rows, seed_rows)
            lists.meet(item_rows["place"].to_numpy(), tile.item_ids)
            of_items = _Plays(item_plays, "item", True, tile.item_ids)
            products = _Products(of_items, of_seeds, heavy_items)
            for part in products.ranges(SLICE_ROWS, _cuts(tile.seed_codes, SLICE_ROWS)):
                blend = Blend([x[part] for x in content], [x[part] for x in collab], weight_content, *products.of(part))
                lists.floors[part] = blend.scores(reached[part])
                lists.put(part, *tile.best(part, k, blend, lists))
            del some, item_rows, item_plays, tile, of_items, products
        return lists

    return blocks.lists(passing, held, best, k, block=F.col("block"), whole=likes is None or likes.whole)
