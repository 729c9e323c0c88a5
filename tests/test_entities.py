"""Name similarity and entity resolution against plain versions that look at all pairs."""

import math
import random
from collections import Counter, defaultdict

import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from touchline.functions.names import birth_match, birth_token, common_subsequence, folded_name, sorted_tokens
from touchline.operators import resolution, similarity
from touchline.sources.shared import staged


def names(seed=3, n=60):
    rnd = random.Random(seed)
    first, last = ["anna", "marco", "luis", "jose", "karim", "li"], ["verratti", "silva", "da costa", "müller", "mueller", "ng", "verrati", "silvà"]
    out = [f"{rnd.choice(first)} {rnd.choice(last)}" for _ in range(n)]
    out = [x.replace("a", rnd.choice("ae"), 1) if rnd.random() < 0.3 else x for x in out]
    return [*out, None, "", "ab", "a b", "abc", "verratti marco", "anna anna anna", out[0], out[0]]


def people(spark, texts, start=0):
    return spark.createDataFrame([(start + i, t, "x", 1) for i, t in enumerate(texts)], "id long, name string, g string, w int").repartition(3)


def cosine_matches(a, b, floor, top, others_only=False):
    grams = lambda t: Counter(t.replace(" ", "")[i : i + 3] for i in range(len(t.replace(" ", "")) - 2))
    every = [grams(t) for _, t in a + b if t is not None]
    df = Counter(g for c in every for g in c)

    def unit(t):
        w = {g: k * (math.log((1 + len(every)) / (1 + df[g])) + 1) for g, k in grams(t).items()}
        return {g: x / math.sqrt(sum(y * y for y in w.values())) for g, x in w.items()}

    out = []
    for i, s in a:
        u = unit(s or "")
        found = [(-round(sum(x * unit(t or "").get(g, 0) for g, x in u.items()), 9), j) for j, t in b if not (others_only and i == j)]
        out += [(i, j, -x, r) for r, (x, j) in enumerate(sorted(f for f in found if -f[0] >= floor)[:top], 1)]
    return sorted(out)


@pytest.mark.parametrize(("floor", "top", "others_only"), [(0.4, 5, False), (0.25, 2, True), (0.9, 50, True)])
def test_similar_names_equal_all_pairs(spark, floor, top, others_only):
    left = names()
    right = left if others_only else names(5, 40)
    a, b = list(enumerate(left)), list(enumerate(right, 0 if others_only else 1000))
    got = similarity.similar_names(people(spark, left), people(spark, right, b[0][0]), staged, floor=floor, top=top, others_only=others_only)
    assert sorted((r.id_a, r.id_b, round(r.score, 6), r["rank"]) for r in got.collect()) == [(i, j, round(s, 6), r) for i, j, s, r in cosine_matches(a, b, floor, top, others_only)]


def test_names_alike_are_not_all_compared(spark, monkeypatch):
    """Numbered names all reach the floor; the pairs that are summed grow with the names, not with their square."""
    sums, seen = similarity._cosines, []
    monkeypatch.setattr(similarity, "_cosines", lambda pairs, *how: (seen.append(pairs.count()), sums(pairs, *how))[1])
    compared = {}
    for n in (300, 1200):
        seen.clear()
        rows = people(spark, [f"Customer#{i * 7:09d}" for i in range(n)])
        got = similarity.similar_names(rows, rows, staged, floor=0.3, top=5, others_only=True)
        compared[n] = sum(seen)
        if n == 300:
            every = [(i, f"Customer#{i * 7:09d}") for i in range(n)]
            assert sorted((r.id_a, r.id_b, round(r.score, 6), r["rank"]) for r in got.collect()) == [(i, j, round(s, 6), r) for i, j, s, r in cosine_matches(every, every, 0.3, 5, True)]
    assert compared[1200] < 8 * compared[300] and compared[1200] < 1200 * 1200 / 8


@pytest.mark.parametrize("others_only", [False, True])
def test_blocks_equal_all_pairs(spark, monkeypatch, others_only):
    """Names alike and tied, cut into blocks of at most eight: the best of all blocks are the best of all pairs."""
    monkeypatch.setattr(similarity, "BLOCK", 8)
    left = names(n=30) + [f"Customer#{i:05d}" for i in range(0, 60, 3)]
    right = left if others_only else names(5, 25) + [f"Supplier#{i:05d}" for i in range(0, 40, 2)]
    a, b = list(enumerate(left)), list(enumerate(right, 0 if others_only else 1000))
    got = similarity.similar_names(people(spark, left), people(spark, right, b[0][0]), staged, floor=0.2, top=4, others_only=others_only)
    assert sorted((r.id_a, r.id_b, round(r.score, 6), r["rank"]) for r in got.collect()) == [(i, j, round(s, 6), r) for i, j, s, r in cosine_matches(a, b, 0.2, 4, others_only)]


def vectors_of(texts):
    grams = [Counter(t[i : i + 3] for i in range(len(t) - 2)) for t in texts]
    df = Counter(g for c in grams for g in c)
    rows = []
    for i, c in enumerate(grams):
        w = {g: k * (math.log((1 + len(texts)) / (1 + df[g])) + 1) for g, k in sorted(c.items())}
        rows.append({"name": texts[i], "first": i, "g": list(w), "w": [x / math.sqrt(sum(y * y for y in w.values())) for x in w.values()]})
    return pa.Table.from_pylist(rows)


def test_few_are_summed_in_a_block(monkeypatch):
    """A task sums in full a few targets of each query, however many of its block reach the floor."""
    dots, summed = similarity._row_dots, []
    monkeypatch.setattr(similarity, "_row_dots", lambda rows, *how: (summed.append(len(rows)), dots(rows, *how))[1])
    for n in (500, 4000):
        summed.clear()
        rows = vectors_of([f"Customer#{i * 7:09d}" for i in range(n)])
        assert len(similarity.block_nearest(0.3, 6)(rows, rows)) == 6 * n
        assert sum(summed) < 120 * n


def test_no_plan_compares_all_pairs(spark):
    weights = similarity.gram_weights(people(spark, names()), people(spark, names(4), 500), "name", 3, staged)
    for df in (similarity.similar_pairs(weights, 0.4), similarity.ratio_pairs(*(people(spark, names(k)).select("name").where("name <> ''") for k in (1, 2)), 70.0)):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "CartesianProduct" not in plan and "NestedLoop" not in plan


def test_empty_sides(spark):
    none = people(spark, [])
    for a, b in ((none, none), (people(spark, ["abc def"]), none), (none, people(spark, ["abc def"]))):
        assert similarity.similar_names(a, b, staged).collect() == [] and similarity.best_names(a, b, staged).collect() == []


def test_common_subsequence():
    rnd = random.Random(1)
    for _ in range(300):
        a, b = ("".join(rnd.choices("abcé", k=rnd.randint(0, 12))) for _ in range(2))
        table = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i, x in enumerate(a):
            for j, y in enumerate(b):
                table[i + 1][j + 1] = table[i][j] + 1 if x == y else max(table[i][j + 1], table[i + 1][j])
        assert common_subsequence(a, b) == table[-1][-1]


def ratio(a, b):
    a, b = (" ".join(sorted(x.split())) for x in (a, b))
    return 200 * common_subsequence(a, b) / (len(a) + len(b)) if a and b else 0.0


def one_to_one(a, b, cutoff, floor):
    edges = defaultdict(list)
    for i, s in a:
        found = sorted((-ratio(s, t), j) for j, t in b if s and t and ratio(s, t) >= floor)[:2]
        if found and -found[0][0] >= cutoff:
            edges[found[0][1]].append((found[0][0], i, -found[1][0] if len(found) > 1 else None))
    out = []
    for j, claims in edges.items():
        score, i, second = sorted(claims)[0]
        rivals = [x for x in (second, *(-c[0] for c in sorted(claims)[1:])) if x is not None]
        out.append((i, j, round(-score, 6), round(max(rivals), 6) if rivals else None))
    return sorted(out)


@pytest.mark.parametrize(("cutoff", "floor"), [(70.0, 50.0), (90.0, 60.0), (55.0, 30.0)])
def test_best_names_equal_all_pairs(spark, cutoff, floor):
    left, right = names(), names(8, 50)
    left += ["x", "li", "li ng", "ng li"]
    right += ["x", "il", "ng li"]
    got = similarity.best_names(people(spark, left), people(spark, right, 1000), staged, cutoff=cutoff, rival_floor=floor).collect()
    assert sorted((r.id_a, r.id_b, round(r.score, 6), None if r.runner_up is None else round(r.runner_up, 6)) for r in got) == one_to_one(list(enumerate(left)), list(enumerate(right, 1000)), cutoff, floor)
    assert len({r.id_b for r in got}) == len({r.id_a for r in got}) == len(got)


def test_few_numbered_names_are_compared(spark, monkeypatch):
    """Names of two kinds with numbers: most reach the floor, few are scored, the matches are those of all pairs."""
    ratios, seen = similarity.ratio_pairs, []
    monkeypatch.setattr(similarity, "ratio_pairs", lambda *how: (seen.append(ratios(*how).count()), ratios(*how))[1])
    left, right = [f"Supplier#{i * 3:09d}" for i in range(40)], [f"Customer#{i * 2:09d}" for i in range(200)]
    got = similarity.best_names(people(spark, left), people(spark, right, 1000), staged).collect()
    assert sorted((r.id_a, r.id_b, round(r.score, 6), None if r.runner_up is None else round(r.runner_up, 6)) for r in got) == one_to_one(list(enumerate(left)), list(enumerate(right, 1000)), 70.0, 50.0)
    assert sum(seen) < len(left) * len(right) / 2


def test_names_and_dates(spark):
    texts = ["Ángel  DI-María ", "Straße Ærø", "Łukasz Đokić", "éa", None, "", "!?", "a_b"]
    got = [r[0] for r in spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string").orderBy("i").select(folded_name(F.col("t"))).collect()]
    assert got == ["angel di maria", "strasse aero", "lukasz dokic", "ea", "", "", "", "a_b"]
    dates = ["1993-12-28", "2001-1-5", "1993-13-01", "1993-00-01", "x-y-z", "1993-12", None, ""]
    assert [r[0] for r in spark.createDataFrame([(i, t) for i, t in enumerate(dates)], "i int, t string").orderBy("i").select(birth_token(F.col("t"))).collect()] == ["28L93", "05A01", "", "", "", "", "", ""]
    pairs = [("1990-01-02", "1990-01-02"), ("1990-01-02", "1990-01-03"), ("1990-03-04", "1990-04-03"), ("1990-01-02", "1991-01-02"), (None, "1990-01-02"), ("", "1990-01-02"), ("bad", "1990-01-02"), ("1990-01-31", "1990-02-01")]
    assert [r[0] for r in spark.createDataFrame([(i, *p) for i, p in enumerate(pairs)], "i int, a string, b string").orderBy("i").select(birth_match(F.col("a"), F.col("b"))).collect()] == [100, 90, 80, 0, None, None, 0, 0]
    assert spark.createDataFrame([("b a  c",)], "t string").select(sorted_tokens(F.col("t"))).first()[0] == "a b c"


COLUMNS = "id long, name string, short_name string, birth_date string, position string, number string, team string"


def squads():
    rnd = random.Random(11)
    first, last = ["Ana", "Märco", "Luís", "José", "Karim", "Bo"], ["Verratti", "Silva", "Costa", "Müller", "Nguyen", "Andersson", "Okafor"]
    a, b = [], []
    for i in range(70):
        name = f"{rnd.choice(first)} {rnd.choice(last)}"
        born = f"19{80 + i % 15}-{1 + i % 12:02d}-{1 + i % 27:02d}"
        a.append((i, name, f"{name[0]}. {name.split()[1]}" if i % 3 else None, born if i % 7 else None, ["GK", "Left Back", "Winger", None][i % 4], str(i % 30), ["Roma", "PSG", None][i % 3]))
        other = name if i % 4 else name.split()[1] + " " + name.split()[0]
        y, m, d = born.split("-")
        b.append((1000 + i, other.upper() if i % 5 else other[:-1], None, [born, f"{y}-{d}-{m}", f"{y}-{m}-{int(d) + 1:02d}", None][i % 4], ["Goalkeeper", "Defender", "Forward", "Midfield"][i % 4], str(i % 30 if i % 2 else 99), ["roma", "PSG", "Ajax"][i % 3]))
    return [*a, (500, None, None, None, None, None, None), (501, a[1][1], None, None, None, None, None)], [*b, (1500, "", None, None, None, None, None)]


def layers_by_hand(spark, a, b):
    """The layers with all pairs looked at; names are folded by the function tested above."""
    fold = {t: v for t, v in spark.createDataFrame([(t,) for t in {x for r in a + b for x in (r[1], r[2], r[6]) if x}], "t string").select("t", folded_name(F.col("t"))).collect()}
    group = lambda p: next((g for k, g in resolution.POSITION_GROUPS if p and k in p.lower()), None)

    def dob(x, y):
        if not x or not y:
            return None
        if x == y:
            return 100.0
        p, q = x.split("-"), y.split("-")
        if p[0] == q[0] and p[1] == q[1] and abs(int(p[2]) - int(q[2])) <= 1:
            return 90.0
        return 80.0 if p[0] == q[0] and p[1] == q[2] and p[2] == q[1] else 0.0

    token = lambda d: f"{int(d.split('-')[2]):02d}{'ABCDEFGHIJKL'[int(d.split('-')[1]) - 1]}{d[2:4]}" if d and int(d.split("-")[1]) <= 12 else ""
    full, short = lambda r: fold.get(r[1], ""), lambda r: fold.get(r[2], "")
    sought = lambda r: " ".join(x for x in (full(r), short(r), token(r[3])) if x)
    out = []
    for k, layer in enumerate(resolution.LAYERS, 1):
        la, lb = a, b
        if layer.team:
            teams = {fold.get(r[6]) for r in a} & {fold.get(r[6]) for r in b} - {None}
            la, lb = ([r for r in rows if fold.get(r[6]) in teams] for rows in (a, b))

        def score(r, s):
            options = [(full(r), full(s)), (short(r), full(s)), (full(r), short(s)), (short(r), short(s))]
            parts = [(0.60, max(ratio(x, y) for x, y in options if x and y or (x, y) == options[0]))]
            if layer.birth and dob(r[3], s[3]) is not None:  # noqa: B023
                parts.append((0.25, dob(r[3], s[3])))
            if group(r[4]) and group(s[4]):
                parts.append((0.15, 100.0 if group(r[4]) == group(s[4]) else 25.0))
            base = sum(w * x for w, x in parts) / sum(w for w, _ in parts)
            return round(min(100.0, base + 3) if layer.number and r[5] and r[5] == s[5] else base, 6)  # noqa: B023

        by_id = {r[0]: r for r in a + b}

        def best(left, right):
            pairs = cosine_matches([(r[0], sought(r)) for r in left], [(r[0], sought(r)) for r in right], layer.floor, 5)  # noqa: B023
            own = defaultdict(list)
            for i, j, _, _ in pairs:
                own[i].append((-score(by_id[i], by_id[j]), j))  # noqa: B023
            return {i: min(x) for i, x in own.items()}

        there, back = best(la, lb), best(lb, la)
        found = [(i, j, -s, k) for i, (s, j) in there.items() if back.get(j, (0, None))[1] == i and -s >= layer.threshold]
        out += found
        a, b = [r for r in a if r[0] not in {f[0] for f in found}], [r for r in b if r[0] not in {f[1] for f in found}]
    return sorted(out)


def test_layers_with_shrinking_pools(spark):
    a, b = squads()
    got = resolution.resolve_layers(spark.createDataFrame(a, COLUMNS), spark.createDataFrame(b, COLUMNS), staged).collect()
    assert sorted((r.id_a, r.id_b, r.score, r.layer) for r in got) == layers_by_hand(spark, a, b)
    assert {r.layer for r in got} == {1, 2, 3} and len({r.id_a for r in got}) == len({r.id_b for r in got}) == len(got)


def test_layers_store_and_score_no_more_than_rows(spark, monkeypatch):
    """Numbered names of two sources: what is stored is no larger than the rows, and pairs are scored for the smaller source and its choices alone."""
    row = lambda kind, i: (i, f"{kind}#{i:06d}", None, f"19{60 + i % 40}-{1 + i % 12:02d}-{1 + i % 28:02d}", "Striker", None, "x")
    a, b = [row("Supplier", i) for i in range(0, 100, 5)], [(1000 + r[0], *r[1:]) for r in (row("Customer", i) for i in range(250))]
    stored, scored, score = {}, [], resolution._first
    stage = lambda df, name: (out := staged(df, name), stored.__setitem__(name, max(stored.get(name, 0), out.count())))[0]
    monkeypatch.setattr(resolution, "_first", lambda rows, *how: (scored.append(rows.count()) if "score" in rows.columns else None, score(rows, *how))[1])
    got = resolution.resolve_layers(spark.createDataFrame(a, COLUMNS), spark.createDataFrame(b, COLUMNS), stage).collect()
    assert sorted((r.id_a, r.id_b, r.score, r.layer) for r in got) == layers_by_hand(spark, a, b) != []
    assert max(n for name, n in stored.items() if name != "grams") <= len(a) + len(b)
    assert max(scored) <= len(a) * resolution.TOP


LINK = "source_a string, id_a string, source_b string, id_b string, score double"
RANKS = ["s", "w", "m", "k"]


def clusters(spark, records, links):
    out = resolution.constrained_clusters(spark.createDataFrame(records, "source string, id string"), spark.createDataFrame(links, LINK), RANKS, staged)
    return {(r.source, r.id): (r.cluster_source, r.cluster_id) for r in out.collect()}


def test_two_records_of_a_source_are_parted(spark):
    """Plain components would make one cluster of five with two records of s."""
    records = [("s", "1"), ("s", "2"), ("w", "1"), ("w", "2"), ("m", "1"), ("m", "9")]
    links = [("s", "1", "w", "1", 90.0), ("w", "1", "s", "2", 80.0), ("s", "2", "w", "2", 95.0), ("w", "2", "m", "1", 70.0), ("m", "1", "s", "1", 60.0)]
    got = clusters(spark, records, links)
    assert got == {("s", "1"): ("s", "1"), ("w", "1"): ("s", "1"), ("m", "1"): ("s", "1"), ("s", "2"): ("s", "2"), ("w", "2"): ("s", "2"), ("m", "9"): ("m", "9")}


def clusters_by_hand(records, links):
    rank = lambda r: (RANKS.index(r[0]), r[1])
    root = {r: r for r in records}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    best = defaultdict(float)
    for sa, ia, sb, ib, s in links:
        a, b = (sa, ia), (sb, ib)
        if a in root and b in root:
            for p in ((a, b), (b, a)):
                best[p] = max(best[p], s)
            root[find(a)] = find(b)
    parts, group = defaultdict(list), {}
    for r in records:
        parts[find(r)].append(r)
    for members in parts.values():
        n = Counter(s for s, _ in members)
        if max(n.values()) == 1:
            group |= {r: members[0] for r in members}
            continue
        lead = max(n, key=lambda s: (n[s], -RANKS.index(s)))
        anchors = sorted((r for r in members if r[0] == lead), key=rank)
        claimed = {a: {lead} for a in anchors}
        group |= {a: a for a in anchors}
        top = lambda r: max(best[r, a] for a in anchors)  # noqa: B023, E731
        waiting = []
        for r in sorted((r for r in members if r[0] != lead), key=lambda r: (-top(r), rank(r))):
            linked = sorted((a for a in anchors if best[r, a] > 0 and r[0] not in claimed[a]), key=lambda a: (-best[r, a], rank(a)))
            if linked:
                group[r] = linked[0]
                claimed[linked[0]].add(r[0])
            else:
                waiting.append(r)
        for r in waiting:
            free = [a for a in anchors if r[0] not in claimed[a]]
            group[r] = free[0] if free else r
            if free:
                claimed[free[0]].add(r[0])
    whole = defaultdict(list)
    for r, g in group.items():
        whole[g].append(r)
    return {r: min(m, key=rank) for m in whole.values() for r in m}


@pytest.mark.parametrize("seed", range(3))
def test_clusters_equal_the_serial_version(spark, seed):
    rnd = random.Random(seed)
    records = [(s, f"{i:03d}") for s in RANKS for i in range(25)]
    links = [(*rnd.choice(records), *rnd.choice(records), float(rnd.randint(1, 40))) for _ in range(70)]
    links = [x for x in links if x[0] != x[2]] + [(None, None, "s", "001", 3.0), ("s", "404", "w", "001", 99.0)]
    assert clusters(spark, records, links) == clusters_by_hand(records, links)


def test_hand_decisions_bands_and_quality(spark):
    pairs = [("s", "1", "w", "1", 95.0, 40.0), ("s", "2", "w", "2", 95.0, None), ("s", "3", "w", "3", 60.0, 55.0), ("s", "4", "w", "4", 60.0, 60.0), ("w", "5", "s", "5", 10.0, None), ("s", "6", "w", "7", 96.0, None), ("s", "7", "w", "8", 50.0, None)]
    hand = [("s", "2", "w", "2", "must", 1), ("w", "2", "s", "2", "cannot", 2), ("s", "6", "w", "6", "must", 1), ("s", "8", "w", "9", "cannot", 1)]
    cols = "source_a string, id_a string, source_b string, id_b string, "
    out = resolution.banded(spark.createDataFrame(pairs, cols + "score double, runner_up double"), spark.createDataFrame(hand, cols + "verdict string, decided_at long"), 90.0, 30.0, 10.0)
    got = {(r.id_a, r.id_b): (r.state, r.recommended, r.score) for r in out.collect()}
    assert got == {("1", "1"): ("auto", False, 95.0), ("2", "2"): ("blocked", False, 95.0), ("3", "3"): ("queue", False, 60.0), ("4", "4"): ("queue", False, 60.0), ("5", "5"): ("reject", False, 10.0), ("6", "7"): ("shadowed", False, 96.0), ("6", "6"): ("hand", False, 100.0), ("7", "8"): ("queue", True, 50.0)}
    truth = [("w", "1", "s", "1", "match"), ("s", "6", "w", "6", "non_match"), ("s", "3", "w", "3", "match"), ("s", "5", "w", "5", "non_match")]
    assert tuple(resolution.quality(out, spark.createDataFrame(truth, cols + "label string")).first()) == (0.5, 0.5, 1.0, 4)
    assert tuple(resolution.quality(out.where("false"), spark.createDataFrame([], cols + "label string")).first()) == (None, None, None, 0)
    with pytest.raises(ValueError, match="bands"):
        resolution.banded(out, out, 30.0, 30.0, 1.0)
