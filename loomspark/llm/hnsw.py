"""Hierarchical navigable small-world graph over unit vectors, built and searched in batches with numpy.

Rows are ordered by level, highest first, so the nodes of level L are the first sizes[L] rows and one numbering serves all levels.
"""

from __future__ import annotations

import numpy as np

M = 12
BUILD_BEAM = 48
_BRUTE = 512


def _choose(v: np.ndarray, of: np.ndarray, ids: np.ndarray, sims: np.ndarray, most: int) -> np.ndarray:
    """For each row of ``of`` up to ``most`` of its candidates: those nearer to it than to one chosen before, then the nearest."""
    order = np.argsort(-sims, axis=1, kind="stable")[:, : 2 * most]
    ids, sims = np.take_along_axis(ids, order, 1), np.take_along_axis(sims, order, 1)
    ok = np.isfinite(sims)
    x = v[np.where(ok, ids, 0)]
    among = x @ x.transpose(0, 2, 1)
    worst = np.full(ids.shape, -np.inf, np.float32)
    picked = np.zeros(ids.shape, bool)
    count = np.zeros(len(of), np.int64)
    for i in range(ids.shape[1]):
        take = ok[:, i] & (worst[:, i] < sims[:, i]) & (count < most)
        picked[:, i] = take
        count += take
        worst = np.where(take[:, None], np.maximum(worst, among[:, i]), worst)
    rank = np.where(picked, 0, np.where(ok, 1, 2)) * ids.shape[1] + np.arange(ids.shape[1])
    order = np.argsort(rank, axis=1, kind="stable")[:, :most]
    out = np.where(np.take_along_axis(ok, order, 1), np.take_along_axis(ids, order, 1), -1)
    return np.pad(out, ((0, 0), (0, most - out.shape[1])), constant_values=-1).astype(np.int32)


def beam(v: np.ndarray, links: np.ndarray, q: np.ndarray, entry: np.ndarray, width: int, step: int = 4) -> tuple[np.ndarray, np.ndarray]:
    """The ``width`` best rows found for each query, best first, and their similarities (-inf where there are fewer)."""
    n, m = len(q), len(links)
    seen = np.zeros((n, m), bool)
    ids = np.full((n, width), -1, np.int64)
    sims = np.full((n, width), -np.inf, np.float32)
    done = np.ones((n, width), bool)
    entry = entry[:, : min(width, entry.shape[1])]
    k = entry.shape[1]
    rows = np.arange(n)[:, None]
    ok = entry >= 0
    ids[:, :k] = entry
    sims[:, :k] = np.where(ok, np.einsum("nkd,nd->nk", v[np.maximum(entry, 0)], q), -np.inf)
    done[:, :k] = ~ok
    seen[np.broadcast_to(rows, entry.shape)[ok], entry[ok]] = True
    live = np.arange(n)
    while len(live):
        open_sims = np.where(done[live], -np.inf, sims[live])
        best = np.argpartition(-open_sims, min(step, width) - 1, axis=1)[:, :step]
        good = np.isfinite(np.take_along_axis(open_sims, best, 1))
        go = good.any(1)
        live, best, good = live[go], best[go], good[go]
        if not len(live):
            break
        at = np.broadcast_to(live[:, None], best.shape)
        done[at[good], best[good]] = True
        near = links[np.where(good, ids[at, best], 0)]
        near = np.where(good[:, :, None], near, -1).reshape(len(live), -1)
        fresh = (near >= 0) & ~seen[live[:, None], np.maximum(near, 0)]
        r, c = np.nonzero(fresh)
        key = r * m + near[r, c]
        key = np.unique(key)
        r, to = key // m, key % m
        seen[live[r], to] = True
        got = np.einsum("kd,kd->k", v[to], q[live[r]])
        each = np.bincount(r, minlength=len(live))
        wide = int(each.max(initial=0))
        if not wide:
            continue
        col = np.arange(len(r)) - np.repeat(np.cumsum(each) - each, each)
        new_ids = np.full((len(live), wide), -1, np.int64)
        new_sims = np.full((len(live), wide), -np.inf, np.float32)
        new_ids[r, col], new_sims[r, col] = to, got
        all_ids = np.concatenate([ids[live], new_ids], 1)
        all_sims = np.concatenate([sims[live], new_sims], 1)
        all_done = np.concatenate([done[live], ~np.isfinite(new_sims)], 1)
        top = np.argpartition(-all_sims, width - 1, axis=1)[:, :width]
        ids[live], sims[live], done[live] = (np.take_along_axis(x, top, 1) for x in (all_ids, all_sims, all_done))
    order = np.argsort(-sims, axis=1, kind="stable")
    return np.take_along_axis(ids, order, 1), np.take_along_axis(sims, order, 1)


def chunk_of(m: int) -> int:
    """Queries searched together, so that the marks of seen rows stay within 64 MB."""
    return int(np.clip((64 << 20) // max(m, 1), 16, 1024))


class Graph:
    def __init__(self, v: np.ndarray, sizes: list[int], links: list[np.ndarray]):
        self.v, self.sizes, self.links = v, sizes, links

    def entries(self, q: np.ndarray, above: int) -> np.ndarray:
        """Where to start on the level below ``above`` levels from the top."""
        entry = np.zeros((len(q), 1), np.int64)
        for links in self.links[:above]:
            entry, sims = beam(self.v, links, q, entry, 8)
            entry = np.where(np.isfinite(sims), entry, -1)[:, :4]
        return entry

    def search(self, q: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
        ids, sims = [], []
        k = chunk_of(len(self.v))
        for at in range(0, len(q), k):
            part = q[at : at + k]
            i, s = beam(self.v, self.links[-1], part, self.entries(part, len(self.links) - 1), min(width, len(self.v)))
            ids.append(i)
            sims.append(s)
        return np.concatenate(ids), np.concatenate(sims)


def levels(draw: np.ndarray) -> np.ndarray:
    """Level of each row from uniform numbers in (0, 1]."""
    return np.floor(-np.log(draw) / np.log(M)).astype(np.int64)


def build(v: np.ndarray, level: np.ndarray) -> Graph:
    """v: unit vectors (float32) in order of falling level. Levels are built from the top, each in batches that double."""
    sizes = [int((level >= top).sum()) for top in range(int(level.max(initial=0)), -1, -1)]
    graph = Graph(v, sizes, [])
    for depth, m in enumerate(sizes):
        most = 2 * M if depth == len(sizes) - 1 else M
        links = np.full((m, most), -1, np.int32)
        at = 0
        while at < m:
            to = min(m, max(_BRUTE, 2 * at), at + 2048)
            q = v[at:to]
            inside = q @ q.T
            np.fill_diagonal(inside, -np.inf)
            k = min(BUILD_BEAM, to - at)
            best = np.argpartition(-inside, k - 1, axis=1)[:, :k]
            ids, sims = [best + at], [np.take_along_axis(inside, best, 1)]
            if at:
                found, near = [], []
                c = chunk_of(m)
                for k in range(0, len(q), c):
                    i, s = beam(v, links, q[k : k + c], graph.entries(q[k : k + c], depth), BUILD_BEAM)
                    found.append(i)
                    near.append(s)
                ids.append(np.concatenate(found))
                sims.append(np.concatenate(near))
            ids, sims = np.concatenate(ids, 1), np.concatenate(sims, 1)
            for k in range(0, len(q), 512):
                links[at + k : min(at + k + 512, to)] = _choose(v, np.arange(at + k, min(at + k + 512, to)), ids[k : k + 512], sims[k : k + 512], M)[:, :most] if most == M else np.pad(_choose(v, np.arange(at + k, min(at + k + 512, to)), ids[k : k + 512], sims[k : k + 512], M), ((0, 0), (0, most - M)), constant_values=-1)
            _link_back(v, links, at, to, most)
            at = to
        graph.links.append(links)
    return graph


def _link_back(v: np.ndarray, links: np.ndarray, at: int, to: int, most: int) -> None:
    """The new rows become candidates of those that they chose."""
    src = np.repeat(np.arange(at, to), links.shape[1])
    dst = links[at:to].reshape(-1)
    src, dst = src[dst >= 0], dst[dst >= 0]
    sim = np.einsum("kd,kd->k", v[src], v[dst])
    order = np.lexsort((-sim, dst))
    src, dst, sim = src[order], dst[order], sim[order]
    nodes, start, count = np.unique(dst, return_index=True, return_counts=True)
    place = np.arange(len(dst)) - np.repeat(start, count)
    src, dst, place = (x[place < most] for x in (src, dst, place))
    for k in range(0, len(nodes), 512):
        some = nodes[k : k + 512]
        a, b = np.searchsorted(dst, [some[0], some[-1] + 1])
        new = np.full((len(some), most), -1, np.int64)
        new[np.searchsorted(some, dst[a:b]), place[a:b]] = src[a:b]
        have = links[some].astype(np.int64)
        new = np.where((new[:, :, None] == have[:, None, :]).any(2), -1, new)
        ids = np.concatenate([have, new], 1)
        sims = np.where(ids >= 0, np.einsum("nkd,nd->nk", v[np.maximum(ids, 0)], v[some]), -np.inf)
        links[some] = _choose(v, some, ids, sims, most)
