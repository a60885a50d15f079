import hashlib
import random
import zlib

import numpy as np
import pytest

from pitchhouse.llm import trie

SCHEMA = "conv_id long, turn long, role string, text string, n_convs long, a string"
EMPTY = hashlib.sha256(b"").hexdigest()


def plain_nodes(rows: list, group: int = 100, most: int = 6) -> list:
    """The contract over dictionaries."""
    convs: dict = {}
    for c, turn, role, text, *_ in rows:
        if c is not None:
            role, text = role or "", text or ""
            tie = hashlib.sha256(f"{len(role)}:{role}{text}".encode()).hexdigest()[:32]
            convs.setdefault(c, []).append(((turn is not None, turn or 0, tie), role, text))
    original = {c: [(r, t) for _, r, t in sorted(v)] for c, v in convs.items()}
    members: dict = {}
    ends: dict = {}
    for c, own in original.items():
        h = zlib.crc32(str(c).encode()) % most
        base = c - int(np.fmod(c, group))
        way = (*original.get(base, [])[:h], *own[h:])
        for d in range(len(way) + 1):
            members.setdefault(way[:d], []).append(c)
        ends.setdefault(way, []).append(c)
    children: dict = {}
    for p in members:
        if p:
            children.setdefault(p[:-1], []).append(p)
    out = []

    def walk(p: tuple) -> tuple[int, int]:
        leaves, saved = (0 if children.get(p) else 1), (len(members[p]) - 1) * (len(p[-1][1]) if p else 0)
        for q in children.get(p, []):
            x, y = walk(q)
            leaves, saved = leaves + x, saved + y
        out.append((min(members[p]), len(p), min(members[p[:-1]]) if p else None, len(members[p]), len(children.get(p, [])),
                    leaves, saved, hashlib.sha256(",".join(map(str, sorted(ends.get(p, [])))).encode()).hexdigest()))
        return leaves, saved

    if members:
        walk(())
    return sorted(out, key=str)


def got(df, **given) -> list:
    found = trie.prefix_trie(df, **given)
    assert found.columns == ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    return sorted((tuple(r) for r in found.collect()), key=str)


def conversations(seed: int, n: int, kinds: int = 3) -> list:
    rng = random.Random(seed)
    out = []
    for c in rng.sample(range(-250, 900), n):
        for turn in range(rng.choice([1, 1, 2, 3, 5, 8, 13])):
            out.append((c, rng.choice([turn, turn, turn, None]), rng.choice(["user", "bot", None]),
                        rng.choice(["", None, "é漢😀", "x" * rng.randint(1, 9)][:kinds + 1]), 0, "a"))
    return out


def frame(spark, rows: list):
    return spark.createDataFrame(rows, SCHEMA).repartition(4)


@pytest.fixture(scope="module")
def shared() -> list:
    """Groups of copies, common first turns, conversations that end inside others, a long one and its copy."""
    rows = conversations(1, 40)
    for c in range(2000, 2030):
        rows += [(c, t, "user", "the same", 0, "a") for t in range(4)]
    for c in range(2030, 2050):
        rows += [(c, t, "user", "the same", 0, "a") for t in range(c - 2028)]
    for c in (3000, 3100, 3200):
        rows += [(c, t, "user", f"long {t}", 0, "a") for t in range(60 + c % 7)] + [(c, 99, "user", str(c % 3), 0, "a")]
    return rows


def test_against_plain_python(spark, shared):
    assert got(frame(spark, shared)) == plain_nodes(shared)


def test_small_shards_blocks_and_pieces(spark, shared):
    """Many rounds of spines, carried blocks, broadcast names, lists in pieces: the same nodes."""
    want = plain_nodes(shared)
    assert got(frame(spark, shared), shard_paths=3, block=4, block_rows=7, heavy=5, piece=9) == want
    assert got(frame(spark, shared), shard_nodes=4, heavy=1, block=1) == want


@pytest.mark.parametrize("seed", [2, 3])
def test_random_conversations(spark, seed):
    rows = conversations(seed, 60, seed)
    assert got(frame(spark, rows), shard_paths=4) == plain_nodes(rows)


def test_null_empty_and_repeated_rows(spark):
    assert got(frame(spark, [])) == []
    rows = [(None, 0, "user", "x", 0, "a"), (None, None, None, None, None, None)]
    assert got(frame(spark, rows)) == []
    rows += [(7, None, None, None, None, None)] * 2 + [(7, 0, "u", "b", 0, "")] * 2 + [(7, 0, "u", "c", 0, "")]
    rows += [(103, 1, "u", "only", 0, "")]  # its first turns come from an absent conversation
    assert got(frame(spark, rows)) == plain_nodes(rows)


def test_turnless_members(spark):
    """A conversation whose turns all give way to those of an absent one is a member of the root."""
    ids = [c for c in range(1, 99) if zlib.crc32(str(c).encode()) % 6 >= 2][:3]
    rows = [(c, t, "u", "t", 0, "") for c in ids for t in range(2)]
    assert got(frame(spark, rows)) == [(ids[0], 0, None, 3, 0, 1, 0, hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest())]
    assert EMPTY == plain_nodes([(100, 0, "u", "t")] * 1 + [(100, t, "u", "t") for t in range(1, 7)])[0][-1]


@pytest.mark.parametrize("seed", range(6))
def test_parentheses(seed):
    rng = random.Random(seed)
    opens, depth = [], 0
    while len(opens) < rng.choice([2, 60, 5000, 20_000]) or depth:
        up = depth == 0 or (len(opens) < 20_000 and rng.random() < (0.9 if seed % 2 and len(opens) < 4000 else 0.5))
        opens.append(up)
        depth += 1 if up else -1
    bits = np.array(opens)
    stack, want = [], {}
    for i, up in enumerate(opens):
        if up:
            stack.append(i)
        else:
            want[stack.pop()] = i
    at = np.flatnonzero(bits)
    tree = trie.Parentheses(bits)
    assert tree.close_of(at).tolist() == [want[i] for i in at.tolist()]
    assert tree.pair.tolist() == [opens[i] and i + 1 < len(opens) and not opens[i + 1] for i in range(len(opens))]


def test_sql_on_hand_made_rows(spark, shared):
    """The registered SQL gives the same nodes, negative ids and ties included."""
    import duckdb

    from pitchhouse.llm import sql
    con = duckdb.connect()
    con.register("conversations", frame(spark, shared).toPandas().astype({"turn": "Int64"}))
    want = sorted((tuple(r) for r in con.execute(sql.TRIE).fetchall()), key=str)
    assert want == plain_nodes(shared)
