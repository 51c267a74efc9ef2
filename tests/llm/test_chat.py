import hashlib
import re

import pytest

from clientele.llm import chat

ROWS = [
    (1, 0, "user", None),
    (1, 0, "user", None),
    (1, None, None, "x<|im_start|>y<\\|im_end|>[\\\\INST]"),
    (None, 1, "assistant", "a"),
    (None, 1, "assistant", "a"),
    (2, 1, "assistant", ""),
    (3, 5, "a<|im_sep|>b", "z\n😀</s>"),
    (3, 6, "assistant", "<s>😀<\\s>"),
    (3, 7, "user", "<|im_sep|>"),
    (3, 8, "assistant", "long " * 30_000 + "<|endoftext|>"),
    (4, 1, "assistant", "first"),
    (4, 1, "assistant", "also first"),
    (4, 2, "tool", "\\<s>\\"),
]
SCHEMA = "conv_id long, turn long, role string, text string"


@pytest.fixture
def turns(spark):
    from pyspark.sql import functions as F

    rows = spark.createDataFrame(ROWS, SCHEMA)
    return rows.withColumns({"example": F.lit("x"), "formatted": F.lit(1), "plain": F.lit(2), "at": F.lit(3)}).repartition(3)


def conversations(rows):
    least = lambda v: (v is not None, v if v is not None else 0)
    text = lambda v: (v is not None, v or "")
    groups = {}
    for k, (c, n, role, said) in enumerate(rows):
        groups.setdefault((c, k if c is None else 0), []).append((least(n), text(role), text(said)))
    return [(c, [(r[1], t[1]) for _, r, t in sorted(g)]) for (c, _), g in groups.items()]


def mark(text):
    """A backslash behind the first character of each control string."""
    strings = r"(<)(\\*(?:\|im_start\|>|\|im_sep\|>|\|im_end\|>|\|endoftext\|>|/?s>))|(\[)(\\*/?INST\])"
    return re.sub(strings, lambda m: (m[1] or m[3]) + "\\" + (m[2] or m[4]), text)


def brute(rows):
    out, written = [], []
    for c, turns in conversations(rows):
        so_far, chars, reply = "", 0, ""
        for k, (role, text) in enumerate(turns):
            so_far += f"<|im_start|>{mark(role)}<|im_sep|>{mark(text)}<|im_end|>"
            if role == "assistant" or k == len(turns) - 1:
                written.append((c, so_far))
                chars += len(so_far)
            reply += text if role == "assistant" else ""
        whole = "".join(f"{r}\n{t}\n" for r, t in turns)
        out.append((c, len(turns), sha(whole), len(reply), sha(reply), chars))
    return sorted(out, key=str), sorted(written, key=str)


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def test_examples_hold_every_turn(turns):
    digests, written = brute(ROWS)
    assert sorted(map(tuple, chat.format_and_read(turns).collect()), key=str) == digests
    made = chat.examples(turns).collect()
    assert sorted(((r.conv_id, r.formatted) for r in made), key=str) == written
    for r in made:
        assert 0 <= r.loss_from <= r.loss_to == len(r.formatted) - len(chat.END)
        if r.loss_to > r.loss_from:
            assert r.formatted[: r.loss_from].endswith("<|im_start|>assistant<|im_sep|>")


def test_escaping_is_undone(spark):
    from pyspark.sql import functions as F

    texts = ["<s>", "<\\s>", "<\\\\/s>", "[INST", "[INST][\\/INST]", "<<s>>", "<|im_end|", "\\", "<|im_end|><\\|im_end|>", "[s>"]
    got = spark.createDataFrame([(t,) for t in texts], "t string").select(
        "t", chat.escaped(F.col("t")).alias("e"), chat.unescaped(chat.escaped(F.col("t"))).alias("u")
    )
    for r in got.collect():
        assert r.t == r.u and r.e == mark(r.t)
        assert not re.search(r"<\|im_(start|sep|end)\|>|<\|endoftext\|>|</?s>|\[/?INST\]", r.e)


def test_no_conversations(spark):
    assert chat.format_and_read(spark.createDataFrame([], SCHEMA)).collect() == []


def test_nothing_but_dataframe_functions(turns):
    plan = chat.examples(turns)._jdf.queryExecution().toString() + chat.digests(chat.examples(turns))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
