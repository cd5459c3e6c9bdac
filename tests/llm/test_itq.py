"""Links against all pairs: none false, recall of at least 0.9, counts and components exact for found links."""

import numpy as np
import pytest

from daybook.llm import itq


def data(seed=3, n=400, dims=64):
    r = np.random.default_rng(seed)
    centres = r.standard_normal((10, dims)) * 0.7
    x = [(centres[i % 10] + r.standard_normal(dims)) for i in range(n)]
    out = list(x)
    for i in range(0, n, 3):  # near copies from cosine 0.91 up
        noise = r.standard_normal(dims)
        noise *= np.linalg.norm(x[i]) / np.linalg.norm(noise) * r.choice([0.05, 0.2, 0.42])
        out.append(x[i] + noise)
    out += [x[0]] * 5 + [x[1] * 3.0]
    return [np.asarray(v, np.float32).tolist() for v in out]


def plain(vectors):
    x = np.array(vectors, float)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    s = x @ x.T >= 0.9
    np.fill_diagonal(s, False)
    return s


@pytest.mark.parametrize("dims", [64, 24, 100])
def test_against_all_pairs(spark, dims):
    vectors = data(dims=dims)
    rows = [(k, v, 7) for k, v in enumerate(vectors)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, n int").repartition(3)
    got = {r.vec_id: r for r in itq.near_duplicates(df).collect()}
    links = plain(vectors)
    assert len(got) == len(vectors)
    found, want = sum(r.n_links for r in got.values()), int(links.sum())
    assert found <= want and found >= 0.95 * want
    for k, r in got.items():
        assert r.n_links <= links[k].sum() and r.kept == (r.component_id == k)
    for k in (0, len(vectors) - 2):
        assert got[k].n_links >= 5 and got[k].component_id == 0


def directed(n, dims, share, seed=4):
    """Unit vectors whose mean has about the norm ``share``."""
    r = np.random.default_rng(seed)
    c = r.standard_normal(dims)
    x = r.standard_normal((n, dims)) / dims ** 0.5 + share / (1 - share * share) ** 0.5 * c / np.linalg.norm(c)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


@pytest.mark.parametrize("n", [1 << 16, 1 << 20, 1 << 26, 1 << 30])
@pytest.mark.parametrize("share", [0.02, 0.71])
def test_every_width_with_a_common_direction(n, share):
    x = directed(3000, 64, share)
    width, mean, axes, slack = itq.fitted(x[:2500], itq.plan(n)[0])
    a, r = x[2500:], np.random.default_rng(5)
    g = r.standard_normal(a.shape)
    g -= (g * a).sum(1, keepdims=True) * a
    b = 0.9 * a + 0.19 ** 0.5 * g / np.linalg.norm(g, axis=1, keepdims=True)
    d = [itq.disagreement((a, b), mean, w) for w in axes]
    found = np.any([itq.hits(x, width) for x in d], 0) & (sum(x.sum(1) for x in d) <= slack)
    assert found.mean() >= 0.92  # 0.94 less two standard errors of 500 pairs


def test_blocks_are_halved_until_enough_is_found(monkeypatch):
    monkeypatch.setattr(itq, "MORE_CODES", 1)
    x = directed(3000, 64, 0.71)
    width, mean, axes, slack = itq.fitted(x, 32)
    assert width < 32
    for pair in itq.threshold_pairs(x[4::5], 0.9):
        assert np.any([itq.hits(itq.disagreement(pair, mean, w), width) for w in axes], 0).mean() >= itq.RECALL
    monkeypatch.setattr(itq, "RECALL", 1.0)
    assert itq.fitted(x, 32)[0] <= width


def test_width_follows_the_number_of_vectors():
    widths = [itq.plan(1 << k)[0] for k in range(0, 41)]
    assert widths == sorted(widths) and widths[16] == 16 and max(widths) == 32 and max(np.diff(widths)) == 1


@pytest.mark.parametrize("width", [16, 21])
def test_links_with_a_common_direction(spark, monkeypatch, width):
    monkeypatch.setattr(itq, "plan", lambda n, threshold: (width, 0))
    r, x = np.random.default_rng(9), directed(300, 64, 0.71)
    g = r.standard_normal(x.shape)
    g -= (g * x).sum(1, keepdims=True) * x
    near = 0.902 * x + (1 - 0.902 ** 2) ** 0.5 * g / np.linalg.norm(g, axis=1, keepdims=True)
    vectors = np.concatenate([x, near]).astype(np.float32).tolist()
    df = spark.createDataFrame(list(enumerate(vectors)), "vec_id long, embedding array<float>")
    found = sum(r.n_links for r in itq.near_duplicates(df).collect())
    want = int(plain(vectors).sum())
    assert found <= want and found >= 0.91 * want


def test_odd_rows(spark):
    a, b = [1.0, 2.0, 3.0], [1.0, 2.0, 3.1]
    rows = [(1, a), (2, b), (3, None), (4, []), (5, [0.0, 0.0, 0.0]), (6, [1.0, float("nan"), 1.0]), (7, [1.0, None, 2.0]),
            (8, [float("inf"), 1.0, 1.0]), (9, [1.0, 2.0]), (10, [-1.0, -2.0, -3.0]), (11, a), (11, a), (None, a), (None, None)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    got = itq.near_duplicates(df).collect()
    assert len(got) == len(rows)
    by = {r.vec_id: r for r in got if r.vec_id is not None}
    for k in (3, 4, 5, 6, 7, 8, 9, 10):
        assert (by[k].n_links, by[k].component_id, by[k].kept) == (0, k, True)
    assert by[1].n_links == 4 and by[1].kept and {by[k].component_id for k in (1, 2, 11)} == {1}
    assert by[2].n_links == 4
    assert itq.near_duplicates(df.limit(0)).count() == 0


def test_balanced_codes():
    x = np.array(data(n=600), float)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    mean, axes = itq.learn(x, 1)
    share = ((x - mean) @ axes[0] >= 0).mean(0)
    assert (abs(share - 0.5) < 0.25).all()
