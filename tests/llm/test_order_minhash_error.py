"""How far the estimated likeness of texts that share half their k-mers is from the exact one."""

import numpy as np

from shelfshare.llm import order_minhash as o


def halves(count, length=600):
    rng = np.random.default_rng(5)
    letters = np.array(list("abcdefghijklmnopqrstuvwxyz "))
    for _ in range(count):
        a, b = ("".join(rng.choice(letters, length)) for _ in "ab")
        yield a, o.edited(a, b)


def figures(count, sketches=o.SKETCHES):
    """The share of pairs estimated as unrelated, the mean exact value and the root mean square error."""
    got, want = [], []
    for a, b in halves(count):
        x, y = set(o.numbered_kmers(a).tolist()), set(o.numbered_kmers(b).tolist())
        both, all_ = len(x & y), len(x | y)  # the shared half stands in the same order in both
        want.append(both * (both - 1) / (all_ * (all_ - 1)))
        got.append(o.likeness(o.signature(a, sketches), o.signature(b, sketches)))
    got, want = np.array(got), np.array(want)
    return (got == 0).mean(), want.mean(), np.sqrt(((got - want) ** 2).mean())


def test_half_shared_is_not_unrelated():
    zeros, exact, error = figures(300)
    assert zeros < 0.01 and 0.1 < exact < 0.12 and error < 0.05
