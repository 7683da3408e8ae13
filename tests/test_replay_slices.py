from shelfstream.streaming import runs


def test_micro_batches_follow_rows_and_cores(monkeypatch):
    monkeypatch.setattr(runs, "SLICE_ROWS", 1_000)
    assert [runs.slices_of(n, 12) for n in (0, 10, 4_000, 6_000, 8_000)] == [4, 4, 4, 6, 8]
    # Sixty times the rows of one slice are no sixty micro-batches, and each core gets at most a slice of its own.
    assert runs.slices_of(60_000, 12) == 8 and runs.slices_of(216_000, 12) == 18
    for n in range(8_000, 400_000, 7_777):
        assert runs.slices_of(n, 12) * 12 * 1_000 >= n
