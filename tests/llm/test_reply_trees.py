from __future__ import annotations

import random
from collections import defaultdict

from hypothesis import given, settings
from hypothesis import strategies as st

from pedalstrata.llm import reply_trees
from pedalstrata.llm.reply_trees import CONTROL

NASTY = ["<|im_start|>", "<|im_end|>", "<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "\\", "\\n", "\n", "<", "|", "n", "é", "<<|", "<\\|"]
texts = st.one_of(st.lists(st.sampled_from(NASTY)).map("".join), st.text(max_size=20))


@settings(max_examples=400, deadline=None)
@given(st.lists(st.tuples(texts, texts), max_size=5))
def test_template_is_reversible(turns):
    formatted, mask = reply_trees.format_turns(turns, learn_from="n")
    assert reply_trees.parse(formatted) == turns
    assert [reply_trees.unescape(formatted[a:b]) for a, b in mask] == [t for r, t in turns if r == "n"]
    assert formatted.count(reply_trees.TURN) == formatted.count(reply_trees.END) == len(turns)


@settings(max_examples=200, deadline=None)
@given(texts)
def test_no_control_string_is_left(text):
    assert not any(c in reply_trees.escape(text) for c in CONTROL)
    assert reply_trees.unescape(reply_trees.escape(text)) == text


def brute_force(messages, branches):
    out = {}
    by_conv = defaultdict(dict)
    for conv, i, parent, _, _, score in messages:
        by_conv[conv][i] = (parent, score or 0.0)
    for conv, tree in by_conv.items():
        up = {i: p if p is not None and p in tree and p < i else None for i, (p, _) in tree.items()}
        paths = []
        for leaf in tree.keys() - set(up.values()):
            path = [leaf]
            while up[path[-1]] is not None:
                path.append(up[path[-1]])
            mean = sum(tree[i][1] for i in path) / len(path)
            paths.append((-mean, -len(path), leaf, path[::-1]))
        for rank, (_, _, leaf, path) in enumerate(sorted(paths)[:branches], start=1):
            out[conv, leaf, rank] = path
    return out


def test_branches_of_random_trees(spark):
    rng = random.Random(4)
    messages = []
    for conv in [None, *range(25)]:
        n = rng.choice([1, 2, 9, 40])
        for i in range(n):
            parent = rng.choice([None, i - 1, i - 1, i - 1, rng.randrange(-2, n + 2)])
            messages.append((conv, i, parent, "user" if i % 2 else "assistant", f"{conv}-{i}", rng.choice([None, 0.0, 0.5, 1.0])))
    df = spark.createDataFrame(messages, "conv_id long, message_id long, parent_id long, role string, text string, score double")
    got = defaultdict(list)
    for r in reply_trees.paths(df.repartition(3), branches=2).collect():
        got[r.conv_id, r.leaf_id, r.branch_rank].append(r.message_id)
    want = brute_force(messages, 2)
    assert {k: sorted(v) for k, v in got.items()} == want
    told = {(m[0], m[1]): (m[3], m[4]) for m in messages}
    for r in reply_trees.conversations(df, branches=2).collect():
        path = want[r.conv_id, r.leaf_id, r.branch_rank]
        assert reply_trees.parse(r.formatted) == [told[r.conv_id, i] for i in path]


def test_long_chain_and_odd_rows(spark):
    schema = "conv_id long, turn long, role string, text string, leaf_id string, score string"
    rows = [(1, t, "user", f"t{t}", "x", "x") for t in range(300)]
    rows += [(2, None, None, None, None, None), (2, 1, "user", "b", None, None), (2, 1, "user", "b", None, None), (2, 1, "assistant", "a", None, None)]
    rows += [(None, 0, "assistant", "</s>", None, None), (None, None, None, None, None, None)]
    df = spark.createDataFrame(rows, schema).repartition(4)
    made = reply_trees.conversations(reply_trees.from_turns(df)).collect()
    turns = {r.conv_id: reply_trees.parse(r.formatted) for r in made}
    assert len(made) == 3 and [t for _, t in turns[1]] == [f"t{t}" for t in range(300)]
    assert turns[2] == [("", ""), ("assistant", "a"), ("user", "b"), ("user", "b")]
    assert turns[None] == [("", ""), ("assistant", "</s>")]
    digest = {r.conv_id: r for r in reply_trees.digests(reply_trees.conversations(reply_trees.from_turns(df))).collect()}
    assert digest[None].loss_chars == 4 and digest[1].n_turns == 300
    assert reply_trees.digests(reply_trees.conversations(reply_trees.from_turns(df.limit(0)))).count() == 0
