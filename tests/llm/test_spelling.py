from __future__ import annotations

import itertools
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from shoptrail.llm import spelling as S
from tests.llm.fixtures import documents, lower, odd_rows


def near(a: str, b: str) -> bool:
    """One letter inserted, deleted or replaced."""
    if abs(len(a) - len(b)) > 1 or a == b:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    short, long = sorted((a, b), key=len)
    return any(long[:k] + long[k + 1:] == short for k in range(len(long)))


def brute_words(rows, letters=7, times=2, slips=False):
    counts = Counter()
    for i, t in rows:
        for run in re.findall("[a-zÀ-ÿ]+", lower(t or "")):
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if slips and h % 31 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            counts[run] += 1
    return {w: n for w, n in counts.items() if len(w) >= letters and n >= times}


def brute(counts, ratio=10):
    partners = {w: [v for v in counts if near(w, v)] for w in counts}
    form = {}
    for w, found in partners.items():
        if found and counts[best := min(found, key=lambda v: (-counts[v], v))] >= ratio * counts[w]:
            form[w] = best
    out = {}
    for w in counts:
        root = w
        while root in form:
            root = form[root]
        out[w] = (form.get(w), root, counts[w], len(partners[w]), counts.get(form.get(w)))
    return out


def found(df):
    rows = df.select("word", "form", "root", "n", "n_near", "form_n").collect()
    out = {r[0]: tuple(r)[1:] for r in rows}
    assert len(out) == len(rows)
    return out


def words(n=500, seed=5):
    """Words with variants of variants, in several lengths and alphabets, and counts that make chains."""
    rng = random.Random(seed)
    counts = {}
    for _ in range(n // 10):
        word = "".join(rng.choice("abcdeé") for _ in range(rng.randint(7, 11)))
        n_word = rng.choice([1, 3, 200, 5000])
        for _ in range(10):
            counts.setdefault(word, n_word + rng.randint(1, 3))
            k, how = rng.randrange(len(word)), rng.randrange(3)
            word = word[:k] + {0: "", 1: rng.choice("abcdeß"), 2: word[k] + rng.choice("abc")}[how] + word[k + 1:]
            if len(word) < 7:
                word += "abcdefg"
            n_word = max(1, n_word // rng.choice([1, 9, 11, 30]))
    return counts


@pytest.mark.parametrize("options", [S.Options(), S.Options(sample=120, cell=5), S.Options(sample=100, cell=30, part=7), S.Options(ratio=2)])
def test_equals_brute_force_whatever_the_cells(spark, options):
    counts = words()
    table = spark.createDataFrame(list(counts.items()), "word string, n long")
    assert found(S.variants(table, options)) == brute(counts, options.ratio)


def text_rows():
    more = "Spelling spelling SPELLING spelling spelling spelling spelling spelling spelling spelling speling speling, speling7speling spellingé spellingé"
    return odd_rows() + [(40, more), (41, more.upper()), (40, more), (42, "ÉCOLESX écolesx Écolesx Écolesx straße7strassen über-fünfzig " * 3), (43, "y" * 70_000 + " " + "y" * 70_000), (44, "y" * 69_999 + " " + "y" * 69_999), (None, "nullid nullidword nullidword")]


@pytest.mark.parametrize("slips", [False, True])
def test_documents_equal_brute_force(spark, slips):
    rows = text_rows()
    spell = S.with_slips if slips else S.as_written
    got = found(S.group(documents(spark, rows), spell=spell))
    assert got == brute(brute_words(rows, slips=slips))
    if not slips:
        assert got["speling"][:2] == (None, "speling") and got["spelling"][2] == 30 and got["y" * 69_999][3] == 1


def test_slips_delete_the_named_letter():
    hit = [i for i in range(2000) if zlib.crc32(f"{i}:variant".encode()) % 31 == 0]
    assert 30 < len(hit) < 100
    for i in range(2000):
        h = zlib.crc32(f"{i}:variant".encode())
        assert S.with_slips(str(i))("variant") == ("variant" if h % 31 else "variant"[:h % 7] + "variant"[h % 7 + 1:])


def test_every_near_pair_is_in_reach():
    """Box pruning leaves out no cell that holds a near word, whatever the cuts."""
    rng = random.Random(2)
    for length in (7, 8):
        base = ["".join(rng.choice("aabbcdé") for _ in range(length)) for _ in range(300)]
        other = ["".join(rng.choice("aabbcdé") for _ in range(length + d)) for d in (0, 1) for _ in range(300)]
        for d in (0, 1):
            members = [w for w in dict.fromkeys(other + base) if len(w) == length + d]
            searches = list(dict.fromkeys(base))
            pairs = S.near_pairs(S.Spelled.of(searches, length), S.Spelled.of(members, length + d), d == 0)
            got = {(searches[i], members[j]) for a, b in pairs for i, j in zip(a, b, strict=True)}
            want = {(a, b) for a, b in itertools.product(searches, members) if near(a, b)}
            if d == 0:  # each pair is found from one side, if both sides search
                back = S.near_pairs(S.Spelled.of(members, length), S.Spelled.of(searches, length), True)
                other_side = {(searches[j], members[i]) for a, b in back for i, j in zip(a, b, strict=True)}
                assert not got & other_side
                got |= other_side
            assert got == want != set()


def test_searches_leave_most_cells_out():
    """A search reaches a part of the cells only, and a smaller one when words are more."""
    rng = np.random.default_rng(0)
    shares = []
    for n in (1_000, 16_000):
        points = S.Spelled.of(["".join(map(chr, row)) for row in rng.integers(97, 123, (n, 9))], 9).points
        tree, _ = S.Tree.fit(points, 20)
        rows, _ = tree.reached(points[:500], "both")
        shares.append(len(rows) / 500 / tree.leaves)
    assert shares[1] < 0.6 * shares[0] < 0.3


def test_equal_points_do_not_split():
    tree, place = S.Tree.fit(np.ones((100, S.AXES), np.int8), 5)
    assert tree.leaves == 1 and not place.any()


def test_chains_are_followed_to_the_last(spark):
    chain = [(f"{'a' * 8}{'b' * k}", f"{'a' * 8}{'b' * (k + 1)}") for k in range(13)]
    got = dict(S.roots(spark.createDataFrame(chain, "word string, form string")).collect())
    assert got == {w: chain[-1][1] for w, _ in chain}


def test_empty_tables(spark):
    assert S.group(documents(spark, [])).collect() == []
    assert S.group(documents(spark, [(1, None), (2, ""), (3, "short only")])).collect() == []
    with pytest.raises(ValueError):
        S.Options(ratio=1)
