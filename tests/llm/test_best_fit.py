import math
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from quantpanel.llm import best_fit
from tests.llm.tables import awkward, documents

PATH = public_tokenizers.path("byte_bpe_50k.json")


def slow_best_fit(sizes, length):
    rooms, places = [], []
    for size in sizes:
        fits = [(room, i) for i, room in enumerate(rooms) if room >= size]
        room, i = min(fits, default=(length, len(rooms)))
        if i == len(rooms):
            rooms.append(length)
        places.append((room, size))
        rooms[i] = room - size
    return len(rooms), sorted(places)


@pytest.mark.parametrize("length", [1, 7, 64, 1000])
def test_best_fit_against_a_search_of_all_sequences(length):
    rng = np.random.default_rng(length)
    sizes = np.sort(rng.integers(1, length + 1, 700))[::-1]
    sequence, offset = best_fit.best_fit(sizes, length)
    count, places = slow_best_fit(sizes.tolist(), length)
    assert sequence.max() + 1 == count
    assert sorted(zip((length - offset).tolist(), sizes.tolist())) == places


def check(frame, length, group_rows=best_fit.GROUP_ROWS):
    """Every id of every row once, in order, without gaps; returns the number of sequences and ids."""
    tokenizer = Tokenizer.from_file(PATH)
    ids, wanted = {}, defaultdict(int)
    for r in frame.collect():
        ids[r.doc_id] = ids.get(r.doc_id) or []
        own = tokenizer.encode(r.text or "", add_special_tokens=False).ids + [2]
        ids[r.doc_id].append(own)
        bounds = [0, *range((len(own) - 1) % length + 1, len(own) + 1, length)]
        for number, (start, stop) in enumerate(zip(bounds, bounds[1:])):
            wanted[r.doc_id, number, start, stop - start, zlib.crc32(np.array(own[start:stop], "<u4").tobytes())] += 1
    by_sequence = defaultdict(list)
    for r in best_fit.pack_best_fit(frame, PATH, length, group_rows=group_rows).collect():
        wanted[tuple(r)[:5]] -= 1
        by_sequence[r.sequence_id].append((r.offset, r.length))
    assert not any(wanted.values())
    for parts in by_sequence.values():
        at = 0
        for offset, size in sorted(parts):
            assert offset == at
            at += size
        assert at <= length
    return len(by_sequence), sum(len(own) for owns in ids.values() for own in owns)


@pytest.mark.parametrize("length,group_rows", [(1024, 20_000), (64, 20_000), (1024, 40)])
def test_documents_are_packed_tight(spark, sf_dir, length, group_rows):
    frame = spark.read.parquet(f"{sf_dir}/documents.parquet")
    used, total = check(frame, length, group_rows)
    assert used <= math.ceil(total / length) * 1.03 + 2


def test_awkward_rows(spark):
    check(awkward(spark), 1024)
    check(awkward(spark).unionByName(awkward(spark)), 50)
    assert best_fit.pack_best_fit(documents(spark, []), PATH).count() == 0


def test_exact_multiples_are_not_padded(spark):
    tokenizer = Tokenizer.from_file(PATH)
    text = " a" * 127
    assert len(tokenizer.encode(text).ids) + 1 == 128
    rows = best_fit.pack_best_fit(documents(spark, [(1, text), (2, text)]), PATH, 64).collect()
    assert sorted((r.doc_id, r.piece, r.start, r.length, r.offset) for r in rows) == [(d, p, 64 * p, 64, 0) for d in (1, 2) for p in (0, 1)]
    assert len({r.sequence_id for r in rows}) == 4
