"""Window packing, whitening and importance resampling against plain versions, with nulls, long texts, ties, repeats and clashing names."""

import hashlib
import itertools
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from tallyloom.llm import exact_spectrum, importance, queries, whitening, window_packing

BYTE_FILE = public_tokenizers.path("byte_bpe_50k.json")
#: Extra columns carry names that operators use inside.
SCHEMA = "doc_id long, text string, doc string, whole int, begin int, task int, number int, at int, rank int, score int, weight int, held int, id int, row int, may int, place int"


def prose(seed, n, words=("anha", "thon", "ering", "of", "the", "edre", "stly", "ounde", "heror", "tion")):
    r = random.Random(seed)
    return " ".join(r.choice(words) + r.choice(("", "", "", ".", ",")) for _ in range(n))


def frame(spark, texts):
    return spark.createDataFrame([(i, t, "d", *[3] * 13) for i, t in texts], SCHEMA).repartition(3)


TEXTS = [
    (1, None), (2, ""), (3, "  \n \t"), (4, "Same Text"), (5, "same text"), (5, "same text"), (None, "no id"), (None, "no id"),
    (6, "Éa ñandú Σας <|endoftext|> 日本 x"), (7, "don't a\xa0b\x1cc 'LL 12ab"), (8, prose(1, 20_000)), (9, prose(2, 900)), (10, prose(2, 900)),
    *[(20 + i, prose(i, 20 + 37 * i)) for i in range(40)],
]


class TestWindowPacking:
    def test_every_id_once_without_padding(self, spark):
        from tokenizers import Tokenizer

        library = Tokenizer.from_file(BYTE_FILE)
        got = window_packing.pack(frame(spark, TEXTS), BYTE_FILE, window=1024, with_ids=True).collect()
        sequences, rows = defaultdict(list), defaultdict(list)
        for r in got:
            sequences[r.sequence_id].append((r.offset, r.length))
            rows[r.doc.doc_id, r.doc.text].append(r)
            assert zlib.crc32(r.ids) == r.ids_crc32 and len(r.ids) == 4 * r.length
        for parts in sequences.values():
            ends = [0, *itertools.accumulate(length for _, length in sorted(parts))]
            assert [o for o, _ in sorted(parts)] == ends[:-1] and not ends[-1] & (ends[-1] - 1) and ends[-1] <= 1024
        for (doc_id, text), times in Counter(TEXTS).items():
            ids = np.array([*library.encode(text or "", add_special_tokens=False).ids, 0], "<u4").tobytes()
            pieces = Counter((r.start, r.length, r.ids_crc32, r.doc_tokens) for r in rows[doc_id, text])
            at = 0
            for start, length, crc, tokens in sorted(pieces.elements())[:: times if times > 1 and len(ids) <= 4096 else 1]:
                assert (start, tokens) == (at, len(ids) // 4) and crc == zlib.crc32(ids[4 * at : 4 * (at + length)])
                at += length
            assert at == len(ids) // 4
        total = sum(r.length for r in got)
        assert sum(sum(n for _, n in p) == 1024 for p in sequences.values()) == total // 1024
        assert {s: len(i) // 4 for s, _, i in window_packing.sequences(window_packing.pack(frame(spark, TEXTS), BYTE_FILE, with_ids=True)).collect()} == {
            s: sum(n for _, n in p) for s, p in sequences.items()
        }

    def test_digests_without_ids_and_empty_table(self, spark):
        both = [window_packing.pack(frame(spark, TEXTS), BYTE_FILE, window=64, with_ids=w).select("doc.doc_id", "start", "length", "ids_crc32", "doc_tokens") for w in (False, True)]
        assert Counter(map(tuple, both[0].collect())) == Counter(map(tuple, both[1].collect()))
        assert window_packing.pack(frame(spark, []), BYTE_FILE).count() == 0
        with pytest.raises(ValueError, match="power of two"):
            window_packing.pack(frame(spark, []), BYTE_FILE, window=1000)

    def test_encoder_equals_the_library(self):
        from tokenizers import Tokenizer

        library, own = Tokenizer.from_file(BYTE_FILE), window_packing.encoder(BYTE_FILE)
        assert own.fast is not None
        r = random.Random(5)
        signs = ["a", "B", " ", "  ", "\n", "\t", "é", "ß", "1", "23", "'s", "'", "'re", "don't", ".", ",", "<|endoftext|>", "\x85", "\xa0", "\x1c", "日", "\x00", "x" * 40, "the ", " and", "½", "²", "ª"]
        texts = ["".join(r.choice(signs) for _ in range(r.randrange(60))) for _ in range(1500)] + [prose(i, 200) for i in range(10)]
        for t in texts:
            assert own.encoded(t) == np.array(library.encode(t, add_special_tokens=False).ids, "<u4").tobytes(), repr(t)

    def test_combinations_are_complete(self):
        r = random.Random(6)
        for depth in (1, 2, 3, 4):
            lengths = sorted(r.sample(range(1, 33), 14))
            got = {tuple(p for p in row if p) for row in window_packing.combinations(np.array(lengths), 32, depth).tolist()}
            want = {c[::-1] for k in range(1, depth + 1) for c in itertools.combinations_with_replacement(lengths, k) if sum(c) == 32}
            assert got == want

    def test_least_squares_meets_its_conditions(self):
        r = np.random.default_rng(7)
        parts = window_packing.combinations(np.arange(1, 65), 64, 3)
        target = np.append(0, r.integers(0, 100, 64)).astype(float)
        x = window_packing.non_negative_least_squares(parts, target, rounds=20_000, tolerance=1e-14)
        dense = np.zeros((65, len(parts)))
        for i, row in enumerate(parts):
            np.add.at(dense[:, i], row[row > 0], 1)
        slope = dense.T @ (dense @ x - target)  # no negative slope anywhere, none at all where x is positive
        assert x.min() >= 0 and slope.min() > -0.2 and np.abs(slope[x > 0.1]).max() < 0.2

    def test_rounding_stays_within_the_histogram(self):
        histogram = {40: 3, 24: 5, 32: 3, 8: 1}
        parts = window_packing.combinations(np.array(sorted(histogram)), 64, 3)
        for repeats in (np.full(len(parts), 9.7), np.full(len(parts), 0.4), np.zeros(len(parts))):
            used = Counter()
            for lengths, times in window_packing.rounded(parts, repeats, histogram):
                for length in lengths:
                    used[length] += times
            assert all(used[k] <= n for k, n in histogram.items()) and (sum(used.values()) > 0) == bool(repeats.any())

    def test_line_has_no_gaps(self):
        r = random.Random(8)
        tables = [{}, {3: 1}, {1: 5, 2: 2}, {64: 2}, {63: 100}, {5: 1000}] + [{r.randint(1, 64): r.randint(1, 200) for _ in range(r.randint(1, 40))} for _ in range(20)]
        for histogram in tables:
            laid, ends = window_packing.pack_lengths(histogram, 64)
            places, total = {}, sum(k * n for k, n in histogram.items())
            for length, n in histogram.items():
                mine = sorted(map(tuple, laid[laid[:, 0] == length].tolist()), key=lambda p: p[1])
                for (_, first, at, stride), nxt in itertools.zip_longest(mine, mine[1:]):
                    for k in range(first, nxt[1] if nxt else n):
                        places[at + (k - first) * stride] = length
            assert [*itertools.accumulate([0, *[n for _, n in sorted(places.items())]])][:-1] == sorted(places) and sum(places.values()) == total
            assert ends[0] == total // 64 * 64 and ends[-1] == total and all(not k & (k - 1) for k in np.diff(ends).tolist())
        whole = {40: 50, 24: 50, 32: 20, 20: 30, 12: 30}  # combinations fill every window here, nothing is cut
        laid, ends = window_packing.pack_lengths(whole, 64)
        assert len(ends) == 1 and all((at % 64) + length <= 64 for length, _, at, _ in laid.tolist())


def exact_polynomial(matrix):
    """det(xI - A) by the rule of Faddeev and LeVerrier in whole numbers, lowest first."""
    d = len(matrix)
    m, c = [[0] * d for _ in range(d)], [0] * d + [1]
    for k in range(1, d + 1):
        m = [[sum(matrix[i][t] * m[t][j] for t in range(d)) + (c[d - k + 1] if i == j else 0) for j in range(d)] for i in range(d)]
        c[d - k] = -sum(matrix[i][t] * m[t][i] for i in range(d) for t in range(d)) // k
    return c


class TestWhitening:
    @staticmethod
    def gram(rows):
        a = np.array(rows, dtype=object)
        return (a.T @ a).tolist()

    def test_polynomial_is_exact(self):
        r = random.Random(9)
        for d in (1, 2, 3, 6, 9):
            for scale in (1, 10**6, 10**25):
                matrix = self.gram([[r.randint(-scale, scale) * (r.random() < 0.6) for _ in range(d)] for _ in range(d + 2)])
                primes = exact_spectrum.enough_primes(matrix)
                residues = {p: exact_spectrum.polynomial_modulo(np.array([[x % p for x in row] for row in matrix], np.int64), p).tolist() for p in primes}
                assert exact_spectrum.combined(residues) == exact_polynomial(matrix)

    def test_primes(self):
        found = list(itertools.islice(exact_spectrum.primes_below(2000), 200))
        assert found == [n for n in range(1999, 2, -1) if all(n % k for k in range(2, n))][:200]

    def test_roots_by_multiplicity(self):
        def from_roots(roots):
            c = [1]
            for x in roots:
                c = [a - x * b for a, b in zip([0, *c], [*c, 0], strict=True)]
            return c

        one = 1 << exact_spectrum.FRACTION
        roots = [9, 9, 9, 7, 5, 5, 1, 0, 0]
        assert exact_spectrum.Roots(from_roots(roots)).largest(99) == [(9 * one, 3), (7 * one, 1), (5 * one, 2), (1 * one, 1)]
        assert exact_spectrum.Roots(from_roots(roots)).largest(4) == [(9 * one, 3), (7 * one, 1)]
        (high, _), (low, _) = exact_spectrum.Roots([1, -3, 1]).largest(2)  # (3 +- sqrt 5) / 2
        assert abs(high / one - (3 + 5**0.5) / 2) < 1e-15 and abs(low / one - (3 - 5**0.5) / 2) < 1e-15

    def test_components_of_close_and_equal_roots(self):
        r = np.random.default_rng(10)
        close = self.gram(r.integers(-9, 9, (40, 5)).tolist())
        for i in range(5):  # two roots that differ in the 14th digit
            for j in range(5):
                close[i][j] = 10**13 * (i == j) + close[i][j]
        for matrix in (close, [[7 * (i == j and i != 2) for j in range(4)] for i in range(4)]):
            d = len(matrix)
            primes = exact_spectrum.enough_primes(matrix)
            found = exact_spectrum.Roots(exact_spectrum.combined({p: exact_spectrum.polynomial_modulo(np.array([[x % p for x in row] for row in matrix], np.int64), p).tolist() for p in primes})).largest(d)
            vectors = np.vstack([exact_spectrum.null_space(matrix, root, times) for root, times in found])
            values = [root / 2**exact_spectrum.FRACTION for root, times in found for _ in range(times)]
            assert np.abs(vectors @ vectors.T - np.eye(len(vectors))).max() < 1e-12
            base = 10**13 if matrix is close else 0  # the same vectors without the large multiple of the identity
            small = np.array(matrix, dtype=object) - base * np.eye(d, dtype=int).astype(object)
            assert np.abs(small.astype(float) @ vectors.T - vectors.T * (np.array(values) - base)).max() < 0.1

    SCHEMA = "vec_id long, embedding array<float>, doc string, w int, component int, n int"

    def rows(self, seed=11, n=300, d=6):
        r = np.random.default_rng(seed)
        data = r.normal(size=(n, d)) @ r.normal(size=(d, d))
        out = [(i, [float(np.float32(x)) for x in v]) for i, v in enumerate(data)]
        bad = [(900, None), (901, []), (902, [1.0] * (d - 1)), (903, [None] + [1.0] * (d - 1)), (904, [float("nan")] * d), (905, [float("inf")] * d), (906, [1e30] * d)]
        return out + out[:5] + [(None, out[7][1])], bad

    def test_against_numpy(self, spark):
        good, bad = self.rows()
        vectors = spark.createDataFrame([(i, v, "d", 1, 2, 3) for i, v in good + bad], self.SCHEMA).repartition(4)
        got = whitening.with_whitened(vectors, components=4).collect()
        x = np.floor(64 * np.array([v for _, v in good])).astype(np.int64) + 1_000_000
        n, sums = len(x), x.sum(axis=0)
        values, axes = np.linalg.eigh(np.cov(x.T, bias=True))
        whitened = (x - sums / n) @ axes[:, ::-1] / np.sqrt(values[::-1])
        want = defaultdict(list)
        for (i, _), w, deviation in zip(good, np.abs(whitened[:, :4]), ((n * x - sums) ** 2).sum(axis=1), strict=True):
            for k in range(4):
                want[i, k + 1].append((int(deviation), w[k]))
        assert len(got) == 4 * n
        found = defaultdict(list)
        for r in got:
            found[r.doc.vec_id, r.component].append((int(r.deviation), abs(r.whitened)))
            assert r.n == n and r.identity_error < 1e-9 and abs(r.explained - values[-r.component] / values.sum()) < 1e-9
        for key, pairs in want.items():
            assert np.allclose(sorted(found[key]), sorted(pairs), rtol=1e-9, atol=1e-9)
        for k in range(1, 5):  # one sign for all rows
            signs = {np.sign(r.whitened) * np.sign(whitened[i, k - 1]) for i, r in ((r.doc.vec_id, r) for r in got if r.component == k and r.doc.vec_id is not None) if abs(r.whitened) > 1e-6}
            assert len(signs) == 1

    def test_few_or_equal_rows(self, spark):
        empty = spark.createDataFrame([], self.SCHEMA)
        assert whitening.with_whitened(empty).count() == 0
        same = spark.createDataFrame([(i, [1.0, 2.0], "d", 1, 2, 3) for i in range(3)], self.SCHEMA)
        assert whitening.with_whitened(same).count() == 0
        line = spark.createDataFrame([(i, [1.0 * i, 2.0 * i, 5.0], "d", 1, 2, 3) for i in range(4)], self.SCHEMA)
        got = whitening.with_whitened(line).collect()  # one direction, the other two have no scale
        assert {r.component for r in got} == {1} and {round(r.explained, 12) for r in got} == {1.0}
        assert sorted(round(abs(r.whitened), 9) for r in got) == sorted(round(abs(x) / 1.25**0.5, 9) for x in (-1.5, -0.5, 0.5, 1.5))

    def test_products_are_exact_for_large_entries(self, spark):
        r = random.Random(12)
        rows = [[r.choice((-1, 1)) * r.random() * 10.0 ** r.randint(0, 16) for _ in range(3)] for _ in range(500)]
        vectors = spark.createDataFrame([(v,) for v in rows], "v array<double>").repartition(3)
        total = whitening.products(vectors, 3)
        y = [[*(math.floor(64 * c) for c in v), 1] for v in rows]
        assert total.tolist() == [[sum(a[i] * a[j] for a in y) for j in range(4)] for i in range(4)]


def plain_resample(texts, target, n=1, buckets=10_000, least=20, percent=10):
    split = [re.findall("[^\x00-/:-`{-\x7f]+", (t or "").translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))) for _, t in texts]
    wanted = [re.findall("[^\x00-/:-`{-\x7f]+", t.lower()) for t in target if t]

    def features(words):
        return [zlib.crc32(" ".join(words[i : i + k]).encode()) % buckets for k in range(1, n + 1) for i in range(len(words) - k + 1)]

    s, t = Counter(), Counter()
    for w in split:
        s.update(features(w))
    for w in wanted:
        t.update(features(w))
    s_all, t_all, out = sum(s.values()), sum(t.values()), []
    for (i, _), w in zip(texts, split, strict=True):
        f = features(w)
        gains = [math.floor(1000 * math.log((t[b] + 1) * (s_all + buckets) / ((s[b] + 1) * (t_all + buckets)))) for b in f]
        weight = sum(gains) // len(gains) if gains else 0
        h = int(hashlib.sha256(f"2024:{'null' if i is None else i}".encode()).hexdigest()[:8], 16)
        out.append((i, len(w), len(f), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))))
    able = sorted((r for r in out if r[1] >= least), key=lambda r: (-r[4], r[0] is None, r[0] or 0))
    return out, able[: percent * len(able) // 100]


class TestResampling:
    @pytest.mark.parametrize("n, percent, least", [(1, 10, 20), (2, 35, 3), (1, 100, 0), (1, 1, 20)])
    def test_against_loops(self, spark, n, percent, least):
        target = [prose(i, 30, ("anha", "the", "Zed")) for i in range(5)] + [None, ""]
        docs, goal = frame(spark, TEXTS), spark.createDataFrame([(t,) for t in target], "text string")
        got = importance.resample(docs, goal, n=n, percent=percent, least_words=least).collect()
        rows, drawn = plain_resample(TEXTS, target, n, least=least, percent=percent)
        assert Counter((r.doc.doc_id, r.n_words, r.n_features, r.weight, r.score) for r in got) == Counter(rows)
        ranked = sorted((r for r in got if r["rank"] is not None), key=lambda r: r["rank"])
        assert [r["rank"] for r in ranked] == list(range(1, len(drawn) + 1))
        assert [(r.doc.doc_id, r.score) for r in ranked] == [(d[0], d[4]) for d in drawn]

    def test_empty_tables(self, spark):
        docs, goal = frame(spark, TEXTS), spark.createDataFrame([], "text string")
        assert importance.resample(frame(spark, []), goal).count() == 0
        rows, drawn = plain_resample(TEXTS, [])
        assert Counter((r.doc.doc_id, r.weight, r["rank"] is None) for r in importance.resample(docs, goal).collect() if r.doc.doc_id is not None) == Counter(
            (r[0], r[3], all(d is not r for d in drawn)) for r in rows if r[0] is not None
        )

    @pytest.mark.parametrize("accuracy", [2, 1000])
    def test_bracket_holds_the_cutoff_among_ties(self, spark, accuracy):
        r = random.Random(13)
        values = [r.choice((1, 5, 5, 5, 5, 7, r.randint(-50, 50))) for _ in range(3000)]
        scores = spark.createDataFrame([(v,) for v in values], "s long").repartition(5)
        ordered = sorted(values, reverse=True)
        for wanted in (1, 2, 300, 1500, 2999, 3000):
            low, high, above = importance.bracket(scores, "s", wanted, len(values), accuracy)
            assert low <= ordered[wanted - 1] <= high and above == sum(v > high for v in values)

    def test_draw_is_exact_when_all_scores_are_equal(self, spark):
        rows = spark.createDataFrame([(i % 50 if i % 7 else None, 4) for i in range(500)], "k long, score long").repartition(6)
        got = importance.draw(rows, F.lit(True), 30, "k").collect()
        ranked = sorted((r["rank"], r.k) for r in got if r["rank"] is not None)
        assert len(got) == 500 and [x for x, _ in ranked] == list(range(1, 151))
        assert [k for _, k in ranked] == sorted(i % 50 for i in range(500) if i % 7)[:150]


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("tables"))
    spark.createDataFrame([(i, t, "en", "s", 1) for i, t in TEXTS if i is not None and i != 5], "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame([(1, prose(3, 40))], "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    r = np.random.default_rng(14)
    spark.createDataFrame([(i, v, 1) for i, v in enumerate(r.normal(size=(200, 40)).tolist())], "vec_id long, embedding array<float>, label int").write.parquet(f"{path}/embeddings.parquet")
    return path


class TestQueries:
    """The registered queries over a small folder of tables, held against the plain versions."""

    def test_op11(self, spark, folder):
        got = queries.PLANS["op11_nnls_packing"](spark, folder)
        assert dict(got.dtypes) == {c: "bigint" for c in ("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")}
        rows = got.collect()
        tokens = {r.doc_id: r.doc_tokens for r in rows}
        assert len(tokens) == sum(i is not None and i != 5 for i, _ in TEXTS) and sum(r.length for r in rows) == sum(tokens.values())
        assert tokens[1] == tokens[2] == 1

    def test_op12(self, spark, folder):
        got = queries.PLANS["op12_embedding_whitening"](spark, folder)
        assert dict(got.dtypes) == {"vec_id": "bigint", "component": "int", "n": "bigint", "deviation": "bigint", "whitened": "double", "explained": "double", "identity_error": "double"}
        rows = got.collect()
        assert Counter(r.component for r in rows) == Counter({k: 200 for k in range(1, 33)}) and max(r.identity_error for r in rows) < 1e-9

    def test_op13(self, spark, folder):
        got = queries.PLANS["op13_importance_resampling"](spark, folder)
        assert dict(got.dtypes) == {c: "bigint" for c in ("doc_id", "n_features", "weight", "score", "rank")}
        texts = [(i, t) for i, t in TEXTS if i is not None and i != 5]
        rows, drawn = plain_resample(texts, [prose(3, 40)])
        place = {d[0]: k + 1 for k, d in enumerate(drawn)}
        assert {r.doc_id: (r.n_features, r.weight, r.score, r["rank"]) for r in got.collect()} == {i: (n, w, s, place.get(i)) for i, _, n, w, s in rows}
