import numpy as np

from signalwatch.llm.mph import PerfectHash


def test_places_are_a_permutation_and_survive_bytes():
    rng = np.random.default_rng(1)
    for n in (0, 1, 2, 1000, 30_000):
        a, b = (rng.integers(0, 2**63, n).astype(np.uint64) for _ in range(2))
        index = PerfectHash.from_bytes(PerfectHash.build(a, b).to_bytes())
        assert sorted(index.find(a, b)) == list(range(n))


def test_keys_that_share_a_half():
    a = np.repeat(np.arange(50, dtype=np.uint64), 20)
    b = np.tile(np.arange(20, dtype=np.uint64), 50)
    assert sorted(PerfectHash.build(a, b).find(a, b)) == list(range(1000))
