"""The sequential placement step, run on all racks of an Arrow batch at once.

Spark partitions the rows by rack and orders them by placement; this helper takes
step t of every rack in the batch together, so the cost per row is a share of a few
array operations. A rack may run over any number of batches: what goes on from one to
the next is the room on its shelves and, where candidates are rated, the rows that
moved, which the rack's width bounds.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

from .. import constants as K

_N = K.NUM_SHELVES
_MULT = np.array([K.SHELF_MULTIPLIERS[s] for s in K.SHELVES])
# Steps between looks at which racks are full.
_CHECK_EVERY = 64
_EYE = np.isin(K.SHELVES, K.EYE_SHELVES)


def _matrix(table: pa.Table, name: str, width: int) -> np.ndarray:
    """A list column of equal lengths as a matrix; NULL entries as NaN."""
    flat = table.column(name).combine_chunks().flatten()
    return flat.to_numpy(zero_copy_only=False).astype(float).reshape(-1, width)


def _column(table: pa.Table, name: str) -> np.ndarray:
    return table.column(name).combine_chunks().to_numpy(zero_copy_only=False)


def _place(scores: np.ndarray, width: np.ndarray, shelf: np.ndarray, starts: np.ndarray,
           sizes: np.ndarray, room: np.ndarray) -> np.ndarray:
    """Shelf index per row and candidate; ``scores`` is (rows, candidates, shelves).

    ``room`` is (racks, candidates, shelves and one for unknown ones) and is brought up
    to date. A rack is done when no shelf has room for its narrowest product; its
    other rows stay, and take room on their shelves.
    """
    candidates = scores.shape[1]
    chosen = np.repeat(shelf[:, None], candidates, axis=1)
    narrowest = np.minimum.reduceat(width, starts)
    order = np.argsort(-sizes, kind="stable")
    lanes = np.arange(candidates)[None, :]
    for step in range(sizes[order[0]]):
        if step % _CHECK_EVERY == 0:
            fits = room[order, :, :_N].max(axis=(1, 2)) >= narrowest[order]
            for r in order[~fits]:
                rest = slice(starts[r] + step, starts[r] + sizes[r])
                room[r] -= np.bincount(shelf[rest], width[rest], minlength=_N + 1)
            order = order[fits]
        order = order[:np.searchsorted(-sizes[order], -step)]
        if not len(order):
            break
        rows = starts[order] + step
        w = width[rows][:, None]
        value = np.where(room[order, :, :_N] >= w[:, :, None], scores[rows], -np.inf)
        to = value.argmax(axis=2)
        fits = np.take_along_axis(value, to[:, :, None], axis=2)[:, :, 0] > -np.inf
        to = np.where(fits, to, shelf[rows][:, None])
        room[order[:, None], lanes, to] -= w
        chosen[rows] = to
    return chosen


def _tier(price: np.ndarray, shelf: np.ndarray) -> np.ndarray:
    bottom, eye = shelf < len(K.BOTTOM_SHELVES), _EYE[shelf]
    return np.select(
        [(price > K.PREMIUM_PRICE) & eye, (price < K.BUDGET_PRICE) & bottom,
         (price > K.PREMIUM_PRICE) & bottom],
        [K.PREMIUM_EYE_BONUS, K.BUDGET_BOTTOM_BONUS, K.PREMIUM_BOTTOM_PENALTY], 1.0)


def _profits(n: np.ndarray, w: np.ndarray, v: np.ndarray) -> np.ndarray:
    """Rack profit from the shelf sums in the last axis."""
    crowd = np.where(n > K.CROWDING_FREE, np.maximum(
        K.CROWDING_FLOOR, 1.0 - K.CROWDING_STEP * (n - K.CROWDING_FREE)), 1.0)
    fill = w / K.SHELF_WIDTH_CM
    dim = np.where(_EYE & (fill > K.FILL_FREE), np.maximum(
        K.FILL_FLOOR, 1.0 - K.FILL_SLOPE * (fill - K.FILL_FREE)), 1.0)
    value = np.where(n > 0, _MULT * crowd * dim * v, 0.0).sum(axis=-1)
    return (1.0 + K.SPREAD_BONUS * ((n > 0).sum(axis=-1) / _N)) * value


def _best_candidate(known: np.ndarray, rows: pa.Table, chosen: np.ndarray,
                    shelf: np.ndarray, rack: np.ndarray) -> np.ndarray:
    """Per rack the first candidate with the highest profit, to four decimals.

    ``known`` has the sums of the rack's seven shelves; an unknown shelf has none.
    """
    sums = [np.repeat(k[:, None, :], chosen.shape[1], axis=1)
            for k in np.moveaxis(known.reshape(-1, 3, _N), 1, 0)]
    price, value, width = (_column(rows, c) for c in ("price", "value", "width"))
    row, lane = np.nonzero(chosen != shelf[:, None])
    for to, sign in ((shelf[row], -1.0), (chosen[row, lane], 1.0)):
        on = to < _N
        r, at = row[on], (rack[row[on]], lane[on], to[on])
        np.add.at(sums[0], at, sign)
        np.add.at(sums[1], at, sign * width[r])
        np.add.at(sums[2], at, sign * value[r] * _tier(price[r], to[on]))
    return np.floor(_profits(*sums) * 1e4 + 0.50001).argmax(axis=1)


def _normals(table: pa.Table) -> np.ndarray:
    """Seven standard normals per row and noisy candidate.

    32 bits make a uniform, and two uniforms make two normals.
    """
    bits = np.frombuffer(b"".join(table.column("noise").to_pylist()), dtype=">u4")
    u = bits.reshape(table.num_rows, -1, 4, 2) / 4294967296.0
    radius, angle = np.sqrt(-2.0 * np.log(1.0 - u[..., 0])), 2.0 * np.pi * u[..., 1]
    pairs = np.stack([radius * np.cos(angle), radius * np.sin(angle)], axis=-1)
    return pairs.reshape(table.num_rows, -1, 8)[:, :, :_N]


@dataclass
class _Going:
    """A rack whose rows go on in the next batch."""
    room: np.ndarray
    known: np.ndarray
    rows: pa.Table | None = None
    chosen: np.ndarray | None = None
    shelf: np.ndarray | None = None


def _as_moves(rows: pa.Table, keep: list[str], to: np.ndarray, shelf: np.ndarray) -> pa.RecordBatch:
    moved = np.flatnonzero(to != shelf)
    out = rows.select(keep).take(pa.array(moved)).combine_chunks()
    columns = [c.combine_chunks() for c in out.columns]
    return pa.RecordBatch.from_arrays([*columns, pa.array((to[moved] + 1).astype(np.int32))],
                                      names=[*keep, "shelf_level"])


def _rated_moves(going: _Going, rows: pa.Table, chosen: np.ndarray, shelf: np.ndarray,
                 rack: np.ndarray, known: np.ndarray, open_rack: int,
                 keep: list[str]) -> tuple[pa.RecordBatch, _Going]:
    """The best candidates' moves of all racks before ``open_rack``, and what goes on.

    Only rows that some candidate moved count from here on.
    """
    some = np.flatnonzero((chosen != shelf[:, None]).any(axis=1))
    rows, chosen, shelf, rack = rows.take(some), chosen[some], shelf[some], rack[some]
    if going.rows is not None:
        rows = pa.concat_tables([going.rows, rows])
        chosen, shelf = (np.concatenate(p) for p in ((going.chosen, chosen), (going.shelf, shelf)))
        rack = np.concatenate([np.zeros(going.rows.num_rows, dtype=rack.dtype), rack])
    best = _best_candidate(np.nan_to_num(known), rows, chosen, shelf, rack)
    done, rest = np.flatnonzero(rack < open_rack), np.flatnonzero(rack == open_rack)
    to = chosen[done, best[rack[done]]]
    return (_as_moves(rows.take(done), keep, to, shelf[done]),
            _Going(going.room, known[-1], rows.take(rest), chosen[rest], shelf[rest]))


def _walk(table: pa.Table, going: _Going | None, keep: list[str], noise_scale: np.ndarray,
          rated: bool) -> tuple[pa.RecordBatch, _Going]:
    """The moves of a batch that are settled, and its last rack."""
    first = _column(table, "position") == 1
    rack = np.cumsum(first)  # 0: the rack from the batch before
    n = rack[-1] + 1
    room = np.full((n, len(noise_scale), _N + 1), K.SHELF_WIDTH_CM)
    room[:, :, _N] = -np.inf
    known = np.full((n, 3 * _N), np.nan)
    if going is None:
        going = _Going(room[0], known[0])
    room[0], known[0] = going.room, going.known
    if rated:
        head = table.column("shelf").is_null().to_numpy()
        known[rack[head]] = _matrix(table.take(np.flatnonzero(head)), "scores", 3 * _N)
        product = np.flatnonzero(~head & ~np.isnan(known[rack, 0]))
        table, rack = table.take(product), rack[product]
    shelf = _column(table, "shelf").astype(np.int64) - 1
    shelf = np.where(shelf < 0, _N, shelf)
    if table.num_rows:
        starts = np.flatnonzero(np.diff(rack, prepend=-1))
        sizes = np.diff(np.append(starts, len(rack)))
        scores = _matrix(table, "scores", _N)[:, None, :]
        if len(noise_scale) > 1:
            noisy = scores + _normals(table) * noise_scale[None, 1:, None]
            scores = np.concatenate([scores, noisy], axis=1)
        scores = np.where(np.isnan(scores), -np.inf, scores)
        walked = room[rack[starts]]
        chosen = _place(scores, _column(table, "width"), shelf, starts, sizes, walked)
        room[rack[starts]] = walked
    else:
        chosen = np.empty((0, len(noise_scale)), dtype=np.int64)
    if not rated:
        return _as_moves(table, keep, chosen[:, 0], shelf), _Going(room[-1], known[-1])
    moves, after = _rated_moves(going, table, chosen, shelf, rack, known, n - 1, keep)
    after.room = room[-1]
    return moves, after


def placement_task(keep: list[str], noise_scale: list[float], rated: bool) -> Callable[
        [Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Arrow function over rows sorted by rack and placement ``position``.

    Gives one row per moved product: the ``keep`` columns and its new shelf. Shelf 0 is
    an unknown one. One entry of ``noise_scale`` per candidate layout; the first one is
    without noise. Where ``rated``, a head row without a shelf opens each rack and holds
    its shelf sums; racks without one stay as they are.
    """
    scale = np.array(noise_scale)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        going = None
        for batch in batches:
            if not batch.num_rows:
                continue
            moves, going = _walk(pa.Table.from_batches([batch]), going, keep, scale, rated)
            if moves.num_rows:
                yield moves
        if going is not None and going.rows is not None and going.rows.num_rows:
            none = np.empty(0, dtype=np.int64)
            moves, _ = _rated_moves(
                going, going.rows.slice(0, 0), going.chosen[:0], none, none,
                np.stack([going.known, going.known]), 1, keep)
            yield moves

    return task
