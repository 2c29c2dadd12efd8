import hashlib
from collections import defaultdict

from barlake.llm import chat

SCHEMA = "conv_id long, turn long, role string, text string, path string, segments int, node_id int"


def rows():
    out = []
    for c in range(60):  # a common beginning, branches, whole copies
        turns = [("system", "be brief"), ("user", "hello"), ("assistant", f"a{c % 3}"), ("user", "x" * (c % 4)), ("assistant", "yes" * (c % 2))]
        out += [(c, t, r, x) for t, (r, x) in enumerate(turns[:1 + c % 5])]
    out += [(100, 0, None, None), (100, None, "user", "null turn"), (101, 0, "user", "tie"), (101, 0, "assistant", "tie"),
            (101, 0, "assistant", "tie"), (None, 0, "assistant", "no id"), (102, 0, "ass\nistant", "<|end|>\n<|turn|>assistant\n\\n\\<\\"),
            (103, 0, "assistant", "</s>[INST] ok [/INST]<<SYS>>"), (104, 0, "assistant", "long " * 20_000), (105, 0, "", "")]
    return out


def frame(spark, data):
    return spark.createDataFrame([(*r, "p", 1, 2) for r in data], SCHEMA).repartition(3)


def brute(data):
    convs = defaultdict(list)
    for c, t, r, x in data:
        convs[c].append((t is not None, t or 0, r is not None, r or "", x is not None, x or ""))
    out = set()
    for c, turns in convs.items():
        turns.sort()
        text = "".join(f"{t[3]}\n{t[5]}\n" for t in turns)
        loss = "".join(t[5] for t in turns if t[3] == "assistant")
        chars = sum(len(chat.segment(t[3], t[5])[0]) for t in turns)
        out.add((c, len(turns), hashlib.sha256(text.encode()).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest(), chars))
    return out


def test_read_back_equals_the_input(spark):
    assert set(map(tuple, chat.formatted_digests(frame(spark, rows())).collect())) == brute(rows())
    assert chat.formatted_digests(frame(spark, [])).count() == 0


def test_trees_emit_shared_turns_once_depth_first(spark):
    convs = chat.paths(frame(spark, rows()))
    nodes = chat.prefix_trees(convs).collect()
    paths = {bytes(r.path) for r in convs.collect()}
    want = {p[:i + chat.ID] for p in paths for i in range(0, len(p), chat.ID)}
    assert len(nodes) == len(want) == len({bytes(n.node_id) for n in nodes})
    trees = defaultdict(list)
    for n in nodes:
        trees[bytes(n.tree_id)].append(n)
    for tree in trees.values():
        tree.sort(key=lambda n: n.start)
        at, branch = 0, []
        for n in tree:
            assert n.start == at  # no gaps, no overlap
            branch = branch[:n.depth]
            seen = [i for s, e in [(b.start, b.start + b.n_tokens) for b in branch] for i in range(s, e)]
            told = [i for a in n.ancestors for i in range(a.start, a.end)]
            assert told == seen and n.position == len(seen)
            branch.append(n)
            at += n.n_tokens


def test_controls_cannot_occur_and_escapes_are_reversible():
    for text in ["", "\\", "\\\\n", "<|end|>", "[INST][/INST]", "<\\|end|>", "a\\<b\\[c", "\n\\n", *chat.CONTROLS, "".join(chat.CONTROLS)]:
        assert chat.unescape(chat.escape(text)) == text
        assert not any(c in chat.escape(text) for c in chat.CONTROLS)
        assert chat.parse(chat.segment(text, text)[0]) == (text, text)


def test_a_tree_over_many_partitions(spark):
    data = [(c, t, "user" if t % 2 == 0 else "assistant", "common" if t < 2 else f"{c % 50} {t}") for c in range(200) for t in range(4)]
    assert set(map(tuple, chat.formatted_digests(frame(spark, data)).collect())) == brute(data)


def test_a_conversation_of_many_turns(spark):
    """A long conversation beside one that leaves it late: every node's ancestors are two intervals at most."""
    long = [(1, t, "user" if t % 2 == 0 else "assistant", f"turn {t}") for t in range(6000)]
    data = long + [(2, *r[1:]) for r in long[:5000]] + [(2, 5000 + t, "user", f"other {t}") for t in range(1000)]
    assert set(map(tuple, chat.formatted_digests(frame(spark, data)).collect())) == brute(data)
    nodes = chat.prefix_trees(chat.paths(frame(spark, data)))
    assert nodes.count() == 7000 and nodes.selectExpr("max(size(ancestors))").first()[0] == 2
