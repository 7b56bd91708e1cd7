"""The audit of a shard's graph: large groups that it cannot reach, and recall on groups that it can."""

import pickle

import numpy as np
import pytest

from spokewise.llm import vectors


def group(rng, size, dim):
    return rng.normal(size=dim) + 0.02 * rng.normal(size=(size, dim))


def shard_of(raw, layers):
    n = len(raw)
    return vectors.Shard(pickle.dumps((raw, np.arange(n), np.ones(n, np.int64), layers)), 0.95)


def wanted(raw, asked):
    return vectors.unit(asked) @ vectors.unit(raw).T >= 0.95


@pytest.mark.parametrize("size", [50, 500, 5000])
def test_group_that_no_descent_reaches(size):
    rng = np.random.default_rng(size)
    others, members = rng.normal(size=(3000, 16)), group(rng, size, 16)
    parts = []
    for raw in (others, members):
        order, layers = vectors.build(vectors.unit(raw).astype(np.float32), 1)
        parts.append((raw[order], layers))
    (others, layers), (members, inner) = parts
    apart = np.where(inner[-1] >= 0, inner[-1] + len(others), -1)
    raw = np.concatenate((others, members))
    shard = shard_of(raw, [*layers[:-1], np.concatenate((layers[-1], apart))])
    query, vertex = shard.links(members[:64])
    assert (np.stack((query, vertex)) == np.stack(np.nonzero(wanted(raw, members[:64])))).all()


def test_recall_on_groups():
    rng = np.random.default_rng(4)
    sizes = [50, 200, 1000, 5000]
    raw = np.concatenate([rng.normal(size=(2000, 16)), *(group(rng, s, 16) for s in sizes)])
    order, layers = vectors.build(vectors.unit(raw).astype(np.float32), 2)
    shard = shard_of(raw[order], layers)
    begin = 2000
    for size in sizes:
        asked = raw[begin : begin + size][:100]
        begin += size
        query, vertex = shard.links(asked)
        there = wanted(raw[order], asked)
        assert there[query, vertex].all() and len(query) >= vectors.RECALL * there.sum()


def test_beam_follows_all_samples():
    """A task's beam is as wide as its samples together ask for, not as the unluckiest of them does."""
    rng = np.random.default_rng(8)
    raw = rng.normal(size=(11_000, 48)).astype(np.float32)
    order, layers = vectors.build(vectors.unit(raw[:4000]).astype(np.float32), 3)
    shard = shard_of(raw[:4000][order], layers)
    asked = raw[4000:]
    for begin in range(0, len(asked), 512):
        shard.links(asked[begin : begin + 512])
    queries = vectors.unit(asked).astype(np.float32)
    best = shard.candidates(queries, shard.beam)[2]
    assert (best >= (queries @ shard.points.T).max(axis=1) - 1e-6).mean() >= vectors.NEAREST
    assert shard.beam < 2 * vectors.FIRST_BEAM


def test_missed_links_of_a_late_block():
    """Links are audited block by block: good blocks before do not make up for a group that no descent reaches."""
    rng = np.random.default_rng(9)
    others, members = rng.normal(size=(3000, 16)), group(rng, 500, 16)
    parts = []
    for raw in (others, members):
        order, layers = vectors.build(vectors.unit(raw).astype(np.float32), 1)
        parts.append((raw[order], layers))
    (others, layers), (members, inner) = parts
    apart = np.where(inner[-1] >= 0, inner[-1] + len(others), -1)
    raw = np.concatenate((others, members))
    shard = shard_of(raw, [*layers[:-1], np.concatenate((layers[-1], apart))])
    shard.turned = shard.turned[:0]
    for begin in range(0, 2560, 512):
        shard.links(others[begin : begin + 512])
    assert 4 * shard.beam < shard.n
    query, vertex = shard.links(members[:64])
    assert (np.stack((query, vertex)) == np.stack(np.nonzero(wanted(raw, members[:64])))).all()


def test_beam_search_finds_and_sorts():
    """With a beam of the whole graph all that is connected comes once, best first; empty places come last."""
    rng = np.random.default_rng(10)
    points = vectors.unit(rng.normal(size=(300, 8))).astype(np.float32)
    points[150:160] = points[150]
    order, layers = vectors.build(points, 4)
    points, queries = points[order], points[:40]
    ids, sims = vectors.beam_search(layers[-1], points, queries, np.zeros((40, 1), np.int64), 400)
    assert all(len(set(row[row >= 0])) == (row >= 0).sum() >= 299 for row in ids)
    assert ((ids < 0) == (sims == -2)).all() and (np.diff(sims, axis=1) <= 0).all()
    near = np.einsum("qd,qbd->qb", queries, points[np.maximum(ids, 0)])
    assert np.allclose(np.where(ids < 0, -2, near), sims, atol=1e-6)
    assert vectors.beam_search(layers[-1], points, queries[:0], np.zeros((0, 1), np.int64), 8)[0].shape == (0, 8)
