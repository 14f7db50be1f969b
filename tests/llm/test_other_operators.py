"""URLs, archives, chats, embeddings, components and the pipeline."""

import hashlib
import random

import numpy as np
import pytest

from incidentry.llm import queries, warc
from incidentry.llm.chat import (
    Budget, Conversation, count_tokens, escape, format_chats, format_conversation, read_window, unescape,
)
from incidentry.llm.embedding_dedup import compare_blocks, near_duplicate_embeddings
from incidentry.llm.graph import connected_components
from incidentry.llm.queries import RULES, op5_embedding_near_dedup, op7_chat_formatting
from incidentry.llm.url_filter import url_verdicts

SF = "/root/testdata/sf0.001"


def key(row):
    return repr(tuple(row))


def test_url_rules(spark):
    pages = [
        (1, "http://A.Example.org/es/x?y"), (2, "http://example.org/es"), (3, "x://example.org/en/12#/es/"),
        (4, "http://notexample.org/es/1"), (5, None), (6, ""), (7, "example.org/es/"), (8, "http://example.org"),
        (9, "http://q.com/de/1"), (9, "http://q.com/de/1"), (None, "http://q.com/fr/"), (10, "http:///de/"),
        (11, "http://com/fr/\n?"), (12, "http://example.org:80/es/"), (13, "http://" + "a." * 3000 + "org/" + "p" * 9000),
    ]
    want = {
        1: ("a.example.org", "/es/x", "example.org/es/", "block"), 2: ("example.org", "/es", "org/", "allow"),
        3: ("example.org", "/en/12", "example.org/en/1", "block"), 4: ("notexample.org", "/es/1", "org/", "allow"),
        5: ("", "", None, "allow"), 6: ("", "", None, "allow"), 7: ("", "", None, "allow"),
        8: ("example.org", "", None, "allow"), 9: ("q.com", "/de/1", "com/de/", "block"),
        None: ("q.com", "/fr/", "com/fr/", "allow"), 10: ("", "/de/", None, "allow"),
        11: ("com", "/fr/\n", "com/fr/", "allow"), 12: ("example.org:80", "/es/", None, "allow"),
        13: ("a." * 3000 + "org", "/" + "p" * 9000, "org/", "allow"),
    }
    table = spark.createDataFrame([(*p, "h") for p in pages], "page_id bigint, url string, host string")
    rules = spark.createDataFrame([*RULES, (None, "/", "block")], "host string, path string, verdict string")
    got = url_verdicts(table, rules).collect()
    assert len(got) == len(pages)
    assert {r["id"]: tuple(r)[1:] for r in got} == want
    assert url_verdicts(table.limit(0), rules).collect() == []
    assert {r["verdict"] for r in url_verdicts(table, rules.limit(0), default="block").collect()} == {"block"}


def test_the_loss_is_read_at_the_places_of_the_mask():
    """A mark that is moved, cut or beyond the window changes the digest or is refused."""
    text, tokens, marks = next(format_conversation(["user", "assistant"], ["a<b", "c&d [INST]"], Budget()))
    names = ("turn", "role", "start", "end", "kind")
    window = {"text": text, "turns": [dict(zip(names, m, strict=True)) for m in marks]}

    def digest(**changes):
        talk = queries._ReadBack(1)
        talk.add({"text": text, "turns": [window["turns"][0], window["turns"][1] | changes]})
        return talk.loss_chars, talk.loss.hexdigest()

    want = len("c&d [INST]"), hashlib.sha256(b"c&d [INST]").hexdigest()
    start, end = marks[1][2:4]
    assert digest() == want
    for change in ({"start": start + 1}, {"end": end - 1}, {"start": start - 1, "end": end - 1}, {"role": "user"}, {"kind": "repeated"}):
        assert digest(**change) != want
    for change in ({"start": 999, "end": 1000}, {"start": end, "end": start}, {"start": 0, "end": 3}):
        with pytest.raises(ValueError, match="mask"):
            digest(**change)


def test_archives_round_trip(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(warc, "RANGE_BYTES", 3000)
    monkeypatch.setattr(warc, "GAP_BYTES", 10)
    same, long = "<p>é</p>" * 200, "".join(random.Random(1).choice("abcdef\r\n") for _ in range(200_000))
    rows = [
        (1, "http://a/%0A\r\n", same), (2, None, same), (2, "http://b", same), (3, "u", "short"), (4, "u", "short"),
        (5, "u", None), (6, "u", ""), (None, "u", same), (7, "u", long), (8, "", "x" * 999), (9, "u", "x" * 999),
    ]
    pages = spark.createDataFrame([(*r, "p") for r in rows], "page_id bigint, url string, html string, payload string")
    folder = f"file://{tmp_path}/archives"
    index = warc.write_warc(pages.repartition(2), folder)
    index.write.parquet(f"{tmp_path}/index")
    index = spark.read.parquet(f"{tmp_path}/index")
    got = warc.read_warc(index, folder).collect()
    assert len(got) == len(rows)
    kinds = sorted(((r["id"], r["record_type"], r["refers_to"]) for r in got), key=key)
    want = [(i, "response", None) for i in (2, 2, 3, 4, 5, 6, 7, 8, 9)] + [(1, "revisit", 2), (None, "revisit", 2)]
    assert kinds == sorted(want, key=key)
    for r in got:
        payload = next(h or "" for i, _, h in rows if i == r["id"]).encode()
        assert r["payload_bytes"] == len(payload)
        assert r["payload"] is None if r["record_type"] == "revisit" else bytes(r["payload"]) == payload
    assert {(r["id"], r["url"]) for r in got} == {(i, u) for i, u, _ in rows}
    some = warc.read_warc(index.where("id = 7"), folder).collect()
    assert [bytes(r["payload"]).decode() for r in some] == [long]
    assert warc.write_warc(pages.limit(0), folder).collect() == []
    assert warc.read_warc(index.limit(0), folder).collect() == []


def test_ranges_cover_every_record():
    places = [(0, 10), (10, 5), (40, 5), (70_000, 9), (200_000, 9 << 20), (200_000 + (9 << 20), 3)]
    reads = list(warc.coalesce_ranges(places))
    assert [m for _, _, members in reads for m in members] == places
    assert all(low <= a and a + n <= high for low, high, members in reads for a, n in members)
    assert reads[0][:2] == (0, 45)


@pytest.mark.parametrize("seed", range(3))
def test_chat_windows(seed):
    rng = random.Random(seed)
    roles = (["system"] if seed else []) + ["user", "assistant"] * 20
    texts = ["word " * rng.choice([0, 1, 5, 30, 200]) + "<|end|>&lt;[INST]" for _ in roles]
    budget = Budget(window=100, history=40)
    seen = []
    for text, tokens, marks in format_conversation(roles, texts, budget):
        turns = read_window(text)
        assert turns == [(roles[m[0]], texts[m[0]]) for m in marks]
        assert all(unescape(text[m[2] : m[3]]) == texts[m[0]] for m in marks)
        new = [m[0] for m in marks if m[4] == "new"]
        assert tokens <= budget.window or len(new) == 1 or new[:2] == [0, 1]
        assert not seed or marks[0][0] == 0
        seen += new
    assert seen == list(range(len(roles)))


def whole_spans(sizes, system, budget):
    """(first repeated turn, first new turn, end) of each window, from prefix sums of a whole conversation."""
    sums = np.concatenate([[0], np.cumsum(sizes)])
    head = int(system)
    out, new, room = [], head, budget.window - int(sums[head])
    while new < len(sizes):
        back = min(max(head, int(np.searchsorted(sums, sums[new] - budget.history, "left"))), new)
        end = int(np.searchsorted(sums, sums[back] + room, "right")) - 1
        if end <= new:
            back = new
            end = int(np.searchsorted(sums, sums[new] + room, "right")) - 1
        out.append((back, new, min(max(end, new + 1), len(sizes))))
        new = out[-1][2]
    return out


@pytest.mark.parametrize("seed", range(30))
def test_chat_windows_of_a_stream(seed):
    """The windows of turns that come one by one are those of the whole conversation, and few turns are held."""
    rng = random.Random(seed)
    budget = Budget(window=60, history=rng.choice([0, 7, 20, 70]))
    roles = (["system"] if seed % 2 else []) + ["user", "assistant"] * 100
    texts = ["w " * rng.choice([0, 1, 3, 10, 30, 80]) for _ in roles]
    talk, got, most = Conversation(budget), [], 0
    for role, text in zip(roles, texts, strict=True):
        got += list(talk.add(role, text))
        most = max(most, len(talk.past) + len(talk.new))
    got += list(talk.close())
    spans = [
        (*[[m[0] for m in marks if m[4] == kind] for kind in ("repeated", "new")],) for _, _, marks in got
    ]
    sizes = [count_tokens(t) for t in texts]
    want = [(list(range(b, n)), list(range(n, e))) for b, n, e in whole_spans(sizes, seed % 2, budget)]
    if seed % 2:
        want[0] = (want[0][0], [0, *want[0][1]])
    assert spans == want
    assert most <= (budget.window + budget.history) // 2 + 2


def test_chats_are_not_gathered(spark):
    rows = [(None if i % 3 else 1, i, "user", f"turn {i}") for i in range(3000)]
    turns = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string")
    windows = format_chats(turns, Budget(window=50, history=10))
    assert "collect_list" not in windows._jdf.queryExecution().executedPlan().toString()
    new = {}
    for r in sorted(windows.collect(), key=lambda r: (str(r["id"]), r["window"])):
        new.setdefault(r["id"], []).extend(m["turn"] for m in r["turns"] if m["kind"] == "new")
    assert new == {1: list(range(1000)), None: list(range(2000))}


def test_chat_edges(spark):
    rows = [
        (1, 0, "user", "a", 1), (1, 1, "assistant", None, 1), (1, 1, "assistant", None, 1), (1, None, None, "first", 1),
        (None, 0, "us|er<%", "</s>[INST] & &lt;", 1), (2, 5, "system", "only", 1), (3, 0, "user", "w " * 5000, 1),
        (3, 1, "assistant", "", 1),
    ]
    turns = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string, window int")
    got = {}
    for r in sorted(format_chats(turns).collect(), key=lambda r: (str(r["id"]), r["window"])):
        for mark, turn in zip(r["turns"], read_window(r["text"]), strict=True):
            if mark["kind"] == "new":
                got.setdefault(r["id"], []).append(turn)
    assert got == {
        1: [("", "first"), ("user", "a"), ("assistant", ""), ("assistant", "")],
        None: [("us|er<%", "</s>[INST] & &lt;")], 2: [("system", "only")],
        3: [("user", "w " * 5000), ("assistant", "")],
    }
    assert format_chats(turns.limit(0)).collect() == []
    assert "[INST]" not in escape("</s>[INST] ok") and unescape(escape("&lt;<[&#91;")) == "&lt;<[&#91;"


def test_chat_query_equals_the_conversations(spark):
    import hashlib

    rows = spark.read.parquet(f"{SF}/conversations.parquet").orderBy("conv_id", "turn").collect()
    talks = {-1: [("user", "</s>[INST] ok [/INST]"), ("assistant", "</s>[INST] ok [/INST]")]}
    for r in rows:
        talks.setdefault(r["conv_id"], []).append((r["role"], r["text"] or ""))
    got = {r["conv_id"]: r for r in op7_chat_formatting(spark, SF).collect()}
    assert set(got) == set(talks)
    for k, turns in talks.items():
        loss = "".join(t for role, t in turns if role == "assistant")
        all_turns = "".join(f"{role}\n{t}\n" for role, t in turns)
        assert got[k]["n_turns"] == len(turns) and got[k]["loss_chars"] == len(loss)
        assert got[k]["turns_sha256"] == hashlib.sha256(all_turns.encode()).hexdigest()
        assert got[k]["loss_sha256"] == hashlib.sha256(loss.encode()).hexdigest()


def brute_links(rows, cosine=0.95):
    units = []
    for _, v in rows:
        ok = bool(v) and None not in v and bool(np.isfinite(v).all()) and bool(np.any(np.array(v)))
        units.append(np.array(v, float) / np.linalg.norm(np.array(v, float)) if ok else None)
    n = len(rows)
    link = [[i != j and units[i] is not None and units[j] is not None and len(units[i]) == len(units[j])
             and float(units[i] @ units[j]) >= cosine for j in range(n)] for i in range(n)]
    label = list(range(n))
    for i in range(n):
        for j in range(n):
            if link[i][j] and label[i] != label[j]:
                label = [label[i] if x == label[j] else x for x in label]
    out = []
    for i, (d, _) in enumerate(rows):
        ids = [rows[j][0] for j in range(n) if label[j] == label[i] and rows[j][0] is not None]
        out.append((d, sum(link[i]), d if sum(link[i]) == 0 else min(ids, default=None)))
    return out


def test_embeddings_equal_all_pairs(spark):
    rng = np.random.default_rng(5)
    rows = []
    for group in range(12):
        base = rng.normal(size=16)
        for _ in range(int(rng.integers(1, 30))):
            vector = base + rng.normal(size=16) * 0.15 * np.linalg.norm(base) / 4
            rows.append((len(rows), [float(np.float32(x)) for x in vector]))
    rows += [(900, [0.0] * 16), (901, None), (902, []), (903, [None] + [1.0] * 15), (904, [float("nan")] * 16),
             (905, [float("inf")] * 16), (906, [1.0, 2.0, 3.0]), (907, [2.0, 4.0, 6.0]), (908, rows[0][1]),
             (None, rows[1][1]), (5, rows[40][1])]
    table = spark.createDataFrame([(*r, "x") for r in rows], "vec_id bigint, embedding array<float>, node string")
    got = [tuple(r) for r in near_duplicate_embeddings(table).collect()]
    want = [(d, n, c, d == c) for d, n, c in brute_links(rows)]
    assert sorted(got, key=key) == sorted(want, key=key)
    assert near_duplicate_embeddings(table.limit(0)).collect() == []


def fan(n, start=0.0, width=24, plane=0):
    """Vectors 15 degrees apart: each is linked with its neighbours (0.966), none with the next (0.866)."""
    at = np.radians(15 * np.arange(n) + start)
    out = np.zeros((n, width))
    out[:, 2 * plane], out[:, 2 * plane + 1] = np.cos(at), np.sin(at)
    return out


@pytest.mark.parametrize("side", [[0, 0, 0, 0], [0, 1, 0, 1], [1, 0, 0, 0]])
def test_a_block_pair_keeps_a_chain_together(side):
    """a has its least neighbour in x and b in y: the link of a and b counts as well."""
    nodes = np.array([b"0x", b"2a", b"3b", b"1y"], object)
    codes, copies = np.zeros((4, 1, 2), np.int64), np.ones(4, np.int64)
    found = compare_blocks(nodes, fan(4), codes, np.array(side), 0, 0, copies, 0.95)
    linked = [(i, i + 1) for i in range(3) if not any(side) or side[i] != side[i + 1]]
    root = list(nodes)
    for _ in nodes:
        for i, j in linked:
            root[i] = root[j] = min(root[i], root[j])
    times = [sum(i in pair for pair in linked) for i in range(4)]
    assert sorted(found) == sorted((nodes[i], root[i], times[i]) for i in range(4) if times[i])


def test_embeddings_in_chains(spark):
    """Chains of links, by which the first and the last are one component, equal all pairs."""
    rows = [(20 * g + k, v.tolist()) for g in range(12) for k, v in enumerate(fan(11, g, plane=g))]
    table = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")
    got = [tuple(r) for r in near_duplicate_embeddings(table).collect()]
    assert sorted(got) == sorted((d, n, c, d == c) for d, n, c in brute_links(rows))
    assert {c for _, _, c, _ in got} == {20 * g for g in range(12)}


def test_embeddings_with_negative_zeros(spark):
    rows = [(1, [0.6, -0.0, 0.8]), (2, [0.6, 0.0, 0.8]), (3, [0.6, 0.01, 0.8]), (4, [-0.0, 1.0, -0.0]), (5, [0.0, -0.0])]
    table = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")
    got = {tuple(r) for r in near_duplicate_embeddings(table).collect()}
    assert got == {(1, 2, 1, True), (2, 2, 1, False), (3, 2, 1, False), (4, 0, 4, True), (5, 0, 5, True)}


def test_embedding_recall_at_the_limit(spark):
    """Random pairs of a cosine of just 0.95: at least 0.99 of them are found, none below."""
    rng = np.random.default_rng(6)
    rows = []
    for i in range(400):
        a = rng.normal(size=64)
        b = rng.normal(size=64)
        a /= np.linalg.norm(a)
        b -= (b @ a) * a
        b /= np.linalg.norm(b)
        cosine = 0.9501 if i % 2 else 0.9499
        rows += [(2 * i, a.tolist()), (2 * i + 1, (cosine * a + np.sqrt(1 - cosine**2) * b).tolist())]
    table = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")
    links = {r["id"]: r["n_links"] for r in near_duplicate_embeddings(table).collect()}
    assert not any(links[i] for i in range(800) if (i // 2) % 2 == 0)
    assert sum(links[i] == 1 for i in range(800) if (i // 2) % 2) >= 0.99 * 400


def test_embedding_query_equals_all_pairs(spark):
    rows = [(r[0], r[1]) for r in spark.read.parquet(f"{SF}/embeddings.parquet").select("vec_id", "embedding").collect()]
    got = [tuple(r) for r in op5_embedding_near_dedup(spark, SF).collect()]
    assert sorted(got) == sorted((d, n, c, d == c) for d, n, c in brute_links(rows))


def test_components_of_chains_and_stars(spark):
    rng = random.Random(3)
    links = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 30)] + [(7, 7), (500, None)]
    rng.shuffle(links)
    found = connected_components(spark.createDataFrame(links, "a bigint, b bigint")).collect()
    assert {r["node"]: r["root"] for r in found} == {i: 0 for i in range(1, 41)} | {100 + i: 100 for i in range(1, 30)}
