"""Whitening, BK-trees and conversation repair against brute force, on odd rows and on empty tables."""

import hashlib
import itertools
import math
import random
import zlib
from fractions import Fraction

import numpy as np
import pytest
import xxhash
from llm_helpers import prose
from pyspark.sql import functions as F

from starload.llm import bk_trees, conversation_repair as repair, queries, whitening

SF_DIR = "/root/testdata/sf0.01"

VECTORS = "vec_id long, embedding array<float>, label int, x string, size int, n long, entry string"


def got(df) -> list[dict]:
    return [r.asDict() for r in df.collect()]


# -- 11 -----------------------------------------------------------------------------------------


def vectors(seed: int, n: int, size: int) -> list[list[float]]:
    rng = np.random.default_rng(seed)
    return (rng.normal(size=(n, size)) @ rng.normal(size=(size, size)) + rng.normal(size=size) * 5).tolist()


def expected_whitening(rows: list[tuple], size: int) -> dict:
    """(vec_id, component) to values, with fractions for the sums and eigh only at the end."""
    good = [(i, v) for i, v in rows if v is not None and len(v) == size and all(c is not None and math.isfinite(c) for c in v)]
    grid = [(i, tuple(math.floor(64 * float(np.float32(c))) + 1_000_000 for c in v)) for i, v in good]
    fit = sorted({x for _, x in grid})
    n = len(fit)
    sums = [sum(x[j] for x in fit) for j in range(size)]
    v = np.array([
        [float(Fraction(sum((n * x[j] - sums[j]) * (n * x[k] - sums[k]) for x in fit), n**3)) for k in range(size)] for j in range(size)
    ])
    values, basis = np.linalg.eigh(v)
    out = {}
    for i, x in grid:
        deviation = sum((n * x[j] - sums[j]) ** 2 for j in range(size))
        centre = np.array([float(Fraction(n * x[j] - sums[j], n)) for j in range(size)])
        for c in range(size):
            e = values[size - 1 - c]
            out[i, c + 1] = (n, deviation, abs(float(centre @ basis[:, size - 1 - c])) / math.sqrt(e), e / np.trace(v))
    return out


def test_whitening(spark):
    plain = vectors(3, 60, 5)
    rows = list(enumerate(plain)) + [(100 + k, plain[7]) for k in range(30)]
    rows += [(200, None), (201, [1.0, None, 2.0, 3.0, 4.0]), (202, [float("nan")] * 5), (203, [float("inf"), 1.0, 1.0, 1.0, 1.0]),
             (204, []), (205, [1.0, 2.0]), (206, [3e38, 1.0, 1.0, 1.0, 1.0])]
    table = spark.createDataFrame([(i, v, None, "a", 1, 2, "b") for i, v in rows], VECTORS)
    found = got(whitening.whitened(table.repartition(3)))
    want = expected_whitening([r for r in rows if r[0] != 206], 5)
    assert {(r["vec_id"], r["component"]) for r in found} == set(want)
    for r in found:
        n, deviation, whitened, explained = want[r["vec_id"], r["component"]]
        assert (r["n"], r["deviation"]) == (n, deviation)
        assert abs(r["whitened"]) == pytest.approx(whitened, rel=1e-8, abs=1e-8)
        assert r["explained"] == pytest.approx(explained, rel=1e-9)
        assert r["identity_error"] < 1e-9
    signs = {(r["component"], round(r["whitened"], 9)) for r in found if r["vec_id"] in (7, *range(100, 130))}
    assert len(signs) == 5


def test_whitening_beyond_machine_numbers(spark):
    """Entries so far apart that squares and sums leave 64 bits: the same exact results."""
    rows = [(k, [float(2.0**50 * (k % 7) - 3 * 2.0**52), float(k * k), float(-(2.0**49) * (k % 3))]) for k in range(40)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    want = {}
    fit = sorted({tuple(math.floor(64 * c) + 1_000_000 for c in v) for _, v in rows})
    n = len(fit)
    sums = [sum(x[j] for x in fit) for j in range(3)]
    rows_of, size = whitening.gridded(table)
    fitted = whitening.fit(rows_of.select("x").distinct(), size)
    assert fitted.n == n and list(fitted.sums) == sums
    exact = whitening.exact_sums(rows_of.select("x").distinct(), lambda x: whitening.squares(x, fitted.middle), 3)
    v = whitening.covariance(n, fitted.rest, exact)
    for j, k in itertools.product(range(3), repeat=2):
        want = Fraction(sum((n * x[j] - sums[j]) * (n * x[k] - sums[k]) for x in fit), n**3)
        assert v[j, k] == float(want)
    assert {r["deviation"] for r in got(whitening.whitened(table))} == {None}


def test_whitening_without_variance(spark):
    empty = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert got(whitening.whitened(empty)) == []
    same = spark.createDataFrame([(1, [1.0, 2.0]), (2, [1.0, 2.0]), (None, [1.0, 2.0])], empty.schema)
    assert got(whitening.whitened(same)) == []
    flat = spark.createDataFrame([(1, [1.0, 2.0]), (1, [2.0, 2.0]), (None, [5.0, 2.0])], empty.schema)
    rows = got(whitening.whitened(flat))
    assert [r["component"] for r in rows] == [1, 1, 1] and rows[0]["explained"] == pytest.approx(1.0)


def test_whitening_query(spark):
    found = queries.op11_whiten(spark, SF_DIR)
    assert found.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    stored = spark.read.parquet(f"{SF_DIR}/embeddings.parquet").select("vec_id", "embedding").collect()
    want = expected_whitening([(r[0], r[1]) for r in stored], 64)
    rows = got(found)
    assert len(rows) == 16 * len(stored)
    for r in rows:
        n, deviation, whitened, explained = want[r["vec_id"], r["component"]]
        assert (r["n"], r["deviation"]) == (n, deviation) and r["identity_error"] < 1e-9
        assert abs(r["whitened"]) == pytest.approx(whitened, rel=1e-6, abs=1e-6) and r["explained"] == pytest.approx(explained)


# -- 12 -----------------------------------------------------------------------------------------


def plain_fingerprint(text: str | None) -> int:
    words = (text or "").encode().translate(bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))).split()
    runs = [b" ".join(words[i : i + 3]) for i in range(max(len(words) - 2, 1))] if words else []
    hashes = [xxhash.xxh64_intdigest(r, 42) for r in runs]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(prints: list[int], ids: list[int | None], radius: int = 3) -> list[int | None]:
    root = list(range(len(prints)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, j in itertools.combinations(range(len(prints)), 2):
        if (prints[i] ^ prints[j]).bit_count() <= radius:
            root[find(i)] = find(j)
    least: dict[int, int] = {}
    for i, doc in enumerate(ids):
        if doc is not None:
            least[find(i)] = min(least.get(find(i), doc), doc)
    return [least.get(find(i)) for i in range(len(prints))]


def test_fingerprint(spark):
    texts = [None, "", " \n\t", "One", "one two", "A b c", "a  B\tc d", prose(1, 500), "é " * 30, prose(2, 70_000)]
    assert [bk_trees.fingerprint(t.encode() if t is not None else None) for t in texts] == [plain_fingerprint(t) for t in texts]
    spark_hash = spark.sql("select xxhash64('a b c') h").first()["h"]
    assert bk_trees.fingerprint(b"A B  c") == spark_hash % (1 << 64)


def test_linked_documents(spark, odd, none):
    base = prose(1, 80).split()
    more = [(200 + k, " ".join(base[:k] + ["changed"] + base[k + 1 :])) for k in range(0, 80, 4)] + [(300, None), (None, prose(1, 80))]
    docs = odd.unionByName(spark.createDataFrame([(i, t, None, None, None, 1, "r", 1, "w", 1) for i, t in more], odd.schema))
    rows = [(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()]
    prints = [plain_fingerprint(t) for _, t in rows]
    of = plain_components(prints, [i for i, _ in rows])
    want = sorted(((i, f"{p:016x}", c) for (i, _), p, c in zip(rows, prints, of)), key=str)
    found = bk_trees.linked_documents(docs)
    assert found.columns == ["doc_id", "fingerprint", "component_id"]
    assert sorted((tuple(r) for r in found.collect()), key=str) == want
    assert bk_trees.linked_documents(none).count() == 0


def cluster(seed: int, n: int, spread: int, bits=range(64)) -> list[int]:
    rng = random.Random(seed)
    middle = rng.getrandbits(64)
    return [middle ^ sum(1 << b for b in rng.sample(list(bits), rng.randrange(spread + 1))) for _ in range(n)]


@pytest.mark.parametrize("prints", [cluster(1, 900, 9), cluster(2, 1500, 6, range(20)), cluster(3, 30, 1) + cluster(4, 500, 64)])
def test_shards_lose_no_link(spark, prints):
    """Dense clusters, some in few bits, with shards so small that they are split several times."""
    prints = sorted(set(prints))
    table = spark.createDataFrame([(bk_trees.signed(p),) for p in prints], "fp long")
    sharded = bk_trees.shards(table, limit=1)
    sizes = sharded.groupBy("mask", "value").count().agg(F.max("count")).first()[0]
    assert sizes <= 256
    links = bk_trees.shard_links(sharded)
    assert links.where((F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) > 0)).count() <= sharded.count()
    roots = {r["node"]: r["root"] for r in bk_trees.components(links).collect()}
    found = [roots.get(bk_trees.signed(p), bk_trees.signed(p)) for p in prints]
    want = plain_components(prints, list(range(len(prints))))
    assert len(set(zip(found, want))) == len(set(found)) == len(set(want))


def test_trees_follow_only_edges_in_reach():
    rng = random.Random(5)
    points = np.array(sorted({rng.getrandbits(64) for _ in range(400)} | set(cluster(6, 100, 4))), np.uint64)
    starts = np.array([0, 150, 151])
    forest = bk_trees.Forest(points, starts)
    met = {(int(a), int(b)) for q, n in forest.links(3) for a, b in zip(q, n)}
    tree = np.searchsorted(starts, np.arange(len(points)), side="right")
    want = {(i, j) for i, j in itertools.combinations(range(len(points)), 2)
            if tree[i] == tree[j] and (int(points[i]) ^ int(points[j])).bit_count() <= 3}
    assert met == want
    depth = {int(r): 0 for r in starts}
    for child, place in sorted(zip(forest.children.tolist(), forest.place.tolist()), key=lambda c: c[1]):
        parent, edge = divmod(place, bk_trees.BITS + 1)
        assert (int(points[parent]) ^ int(points[child])).bit_count() == edge
        depth[child] = parent
    assert len(depth) == len(points)


def test_simhash_query(spark):
    found = queries.op12_simhash(spark, SF_DIR)
    rows = spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text").collect()
    prints = [plain_fingerprint(r["text"]) for r in rows]
    of = plain_components(prints, [r["doc_id"] for r in rows])
    want = sorted((r["doc_id"], f"{p:016x}", c) for r, p, c in zip(rows, prints, of))
    assert sorted(tuple(r) for r in found.collect()) == want


# -- 13 -----------------------------------------------------------------------------------------

SPACES = " \t\n\x0b\x0c\r"


def damage(rows: list[tuple]) -> dict:
    """conv_id -> rows (turn, role, text) after the damage, in order."""
    out: dict = {}
    for conv, turn, role, text in rows:
        kept = out.setdefault(conv, [])
        key = ":".join(" " if v is None else str(v) for v in (conv, turn))
        fate = zlib.crc32(key.encode()) % 20
        role, text = (" " if role is None else role), (" " if text is None else text)
        if fate == 0:
            continue
        if fate == 1:
            text = ""
        if fate == 2:
            text = "".join(c for c in text if c not in ".!?")
        if fate == 4:
            role = "user"
        kept += [(turn, role, text)] * (2 if fate == 3 else 1)
    for kept in out.values():
        kept.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), hashlib.md5(r[2].encode()).hexdigest()))
    return out


def cheapest(rows: list[tuple]) -> tuple[int, str, list[tuple]]:
    """Least (cost, audit) with its turns, by trying every edit from the front over (row, state) with a queue."""
    import heapq

    done, queue = set(), [(0, "", 0, "", ())]
    while queue:
        cost, audit, at, last, turns = heapq.heappop(queue)
        if at == len(rows) and last in ("", "a"):
            return cost, audit, [t for t in turns]
        if (at, last) in done:
            continue
        done.add((at, last))
        follows = {"": "su", "s": "u", "u": "a", "a": "u"}[last]
        full = {"u": "user", "a": "assistant"}
        for f in follows:
            if f != "s":
                heapq.heappush(queue, (cost + 3, audit + "I", at, f, turns + ((full[f], ""),)))
        if at < len(rows):
            role, text, gone, cut = rows[at]
            heapq.heappush(queue, (cost + 4, audit + "D", at + 1, last, turns))
            if not gone:
                for f in follows:
                    if role[:1] == f:
                        heapq.heappush(queue, (cost + 3 * cut, audit + "K", at + 1, f, turns + ((role, text),)))
                    elif f != "s":
                        heapq.heappush(queue, (cost + 3 + 3 * cut, audit + "R", at + 1, f, turns + ((full[f], text),)))
    raise AssertionError


def expected_repair(rows: list[tuple]) -> list[tuple]:
    out = []
    for conv, kept in damage(rows).items():
        seen, judged = set(), []
        blank = duplicate = truncated = 0
        for _, role, text in kept:
            bare = text.strip(SPACES)
            cut = False
            if not bare:
                blank += 1
            elif (role, text) in seen:
                duplicate += 1
            elif bare[-1] not in ".!?":
                truncated += 1
                cut = True
            gone = not bare or (role, text) in seen
            seen.add((role, text))
            judged.append((role, text, gone, cut))
        illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in itertools.pairwise(kept))
        turns = [t for t, _, _ in kept if t is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        cost, audit, lines = cheapest(judged)
        digest = hashlib.sha256("\n".join(f"{r}:{t}" for r, t in lines).encode()).hexdigest()
        out.append((conv, gaps, blank, duplicate, truncated, illegal, cost, audit, digest))
    return sorted(out, key=str)


COLUMNS = ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
TURNS = "conv_id long, turn long, role string, text string, n int, letters string, signature string"


def repaired(conversations):
    found = repair.repair(conversations)
    assert set(COLUMNS) <= set(found.columns)
    return sorted((tuple(r) for r in found.select(*COLUMNS).collect()), key=str)


def odd_turns(seed: int, convs: int) -> list[tuple]:
    rng = random.Random(seed)
    roles = ["user", "assistant", "system", "user", "assistant", None, "", "tool", "USER", "student"]
    texts = ["Yes.", "No!", "cut", "", " \n", None, "Why?", "end.\r\n", "…", "x" * 3000 + ".", " "]
    rows = []
    for conv in range(convs):
        for turn in range(rng.randrange(9)):
            at = None if rng.random() < 0.1 else turn + rng.choice([0, 0, 0, 1, 5])
            rows.append((None if conv == 3 else conv, at, rng.choice(roles), rng.choice(texts) if rng.random() < 0.6 else prose(turn + 9 * conv, 3) + "."))
    return rows


def test_repair(spark):
    rows = odd_turns(4, 150)
    rows += rows[:40]  # repeated rows
    table = spark.createDataFrame([(*r, 1, "n", "s") for r in rows], TURNS).repartition(5)
    assert repaired(table) == expected_repair(rows)
    assert repair.repair(table.limit(0)).count() == 0


def test_repair_of_one_large_conversation(spark):
    """A third of the rows in one conversation, and one row many times."""
    rng = random.Random(8)
    rows = [(7, k, rng.choice(["user", "assistant"]), f"line {k % 400}.") for k in range(1500)]
    rows += [(9, 0, "user", "Hi.")] * 700 + [(k, t, "user assistant".split()[t % 2], f"{k} {t}.") for k in range(20, 420) for t in range(4)]
    table = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(6)
    assert repaired(table) == expected_repair(rows)
    spread = repair.signatures(repair.once_each(repair.damaged(table)))
    assert {r["conv_id"]: len(r["signature"]) for r in spread.collect()}[7] == len(damage(rows)[7])


def test_automaton_shares_suffixes():
    letters = repair.FINE + repair.CUT + repair.GONE
    rng = random.Random(2)
    given = sorted({"".join(rng.choice(letters) for _ in range(rng.randrange(7))) for _ in range(800)})
    automaton = repair.SuffixAutomaton()
    for backwards in given:
        rows = [(c.lower() if c.lower() in "sua" else "t", "t", c == repair.GONE, c.isupper()) for c in reversed(backwards)]
        assert automaton.solve(backwards) == cheapest(rows)[:2]
    suffixes = {s[:k] for s in given for k in range(1, len(s) + 1)}
    assert automaton.nodes == len(suffixes)


def test_repair_query(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF_DIR}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    found = queries.op13_repair(spark, SF_DIR).select(*COLUMNS)
    assert sorted((tuple(r) for r in found.collect()), key=str) == expected_repair(rows)
