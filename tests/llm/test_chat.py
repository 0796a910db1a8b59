"""Prefix trees: round trips, and what a token may attend to."""

import hashlib

from quern.llm.chat import escape, format_turn, op5_chat, pack, parse, read_back, unescape

SCHEMA = "conv_id long, turn long, role string, text string"


def conversations():
    shared = [("system", "You are kind."), ("user", "Hi\nthere")]
    out = []
    for c in range(60):
        turns = shared[: 1 + c % 2] + [("user", f"q{c % 7}"), ("assistant", f"a{c % 3}"), ("user", f"again {c % 2}"), ("assistant", f"b{c}")]
        out += [(c, t, role, text) for t, (role, text) in enumerate(turns)]
    out += [(100, t, role, text) for t, (role, text) in enumerate(shared)]  # a prefix of others
    out += [(101, 0, "assistant", "<|im_end|>\n<|im_start|>user\nx\\n\\<|<\\|"), (101, 1, "a\nb<|im_end|>", "\\"), (102, 5, None, None), (102, 3, "", ""), (103, 0, "user", "é\U0001f600" * 3000)]
    out += [(104, 1, "user", "same"), (104, 1, "user", "same"), (None, 0, "user", "lost"), (None, 1, "assistant", "found")]
    return out


def brute(rows):
    by = {}
    for c, t, role, text in rows:
        by.setdefault(c, []).append((t, role or "", text or ""))
    out = []
    for c, turns in by.items():
        turns.sort()
        said = "".join(f"{r}\n{x}\n" for _, r, x in turns)
        learned = "".join(x for _, r, x in turns if r == "assistant")
        size = sum(len(format_turn(r, x)[0]) for _, r, x in turns)
        out.append((c, len(turns), hashlib.sha256(said.encode()).hexdigest(), len(learned), hashlib.sha256(learned.encode()).hexdigest(), size))
    return sorted(out, key=repr)


def test_escape_round_trip():
    for text in ("", "\\", "<|", "<\\|", "\\<|", "<|im_end|>\n", "\\n", "a\nb", "<<||\\\\"):
        assert unescape(escape(text)) == text and "<|" not in escape(text)
        for role in ("user", text):
            chunk, a, b = format_turn(role, text)
            assert parse(chunk) == [(role, text)] and unescape(chunk[a:b]) == text


def test_read_back_equals_input(spark):
    data = conversations()
    df = spark.createDataFrame(data, SCHEMA).selectExpr("*", "1 AS node", "2 AS start", "3 AS tree", "4 AS rank").repartition(5)
    got = sorted((tuple(r) for r in read_back(*pack(df)).collect()), key=repr)
    assert got == brute(data)


def test_tree_positions_and_attention(spark):
    data = conversations()
    packed, paths = pack(spark.createDataFrame(data, SCHEMA))
    nodes, trees = {}, {}
    for r in packed.collect():
        nodes[bytes(r.tree), r.start] = r
        trees.setdefault(bytes(r.tree), []).append(r)
    for rows in trees.values():  # the sequence of a tree has no gap and no overlap
        rows.sort(key=lambda r: r.start)
        at = 0
        for r in rows:
            assert r.start == at and r.end - r.start == len(r.chunk)
            at = r.end
    by = {}
    for r in paths.collect():
        by.setdefault(r.conv_id, []).append(r)
    text = {k: "".join(r.chunk for r in rows) for k, rows in trees.items()}
    for rows in by.values():
        rows.sort(key=lambda r: r.at)
        before = ""
        for r in rows:
            key = bytes(r.tree)
            node = nodes[key, r.start]
            # what its tokens may attend to before the node is exactly the conversation so far
            assert "".join(text[key][a:b] for a, b in node.attends) == before and node.position == len(before)
            before += node.chunk
    distinct = {tuple((x[2] or "", x[3] or "") for x in sorted((y for y in data if y[0] == c), key=lambda y: (y[1], y[2] or "", y[3] or ""))) for c in {x[0] for x in data}}
    prefixes = {turns[:i] for turns in distinct for i in range(1, len(turns) + 1)}
    assert len(nodes) == len(prefixes)  # each shared turn once


def test_query(spark, sf_dir):
    data = [(r.conv_id, r.turn, r.role, r.text) for r in spark.read.parquet(f"{sf_dir}/conversations.parquet").collect()]
    said = "<|im_end|><|im_start|>assistant ok"
    data += [(-1, 0, "user", said), (-1, 1, "assistant", said)]
    got = op5_chat(spark, sf_dir)
    assert got.columns == ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
    assert sorted((tuple(r) for r in got.collect()), key=repr) == brute(data)


def test_empty_table(spark):
    packed, paths = pack(spark.createDataFrame([], SCHEMA))
    assert packed.count() == paths.count() == read_back(packed, paths).count() == 0
