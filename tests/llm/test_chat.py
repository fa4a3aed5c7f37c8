import hashlib
import random

from sheetloom.llm.chat import BEGIN, CHUNK, CLOSE, ESC, OPEN, TURN, digest, formatted, read_back

SCHEMA = "conv_id long, turn long, role string, text string"


def plain(rows):
    rows = sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0, r[2] is not None, r[2] or "", r[3] or ""))
    return [(r[2], r[3] or "") for r in rows]


def attacks(rng):
    parts = ["</s>", "[INST] ", " [/INST]", "<s>", "<<SYS>> ", " <</SYS>>", TURN, "<|answer|>", "<|end|>", "<|none|>",
             ESC, ESC + "1", ESC + "0", "<", "[", "[INST", "]", "hello", " ", "\n", "$1", "\\", "é漢", "<|role|>x<|text|>"]
    return "".join(rng.choices(parts, k=rng.randint(0, 12)))


def test_every_text_comes_back(spark):
    rng = random.Random(1)
    rows = []
    for conv in range(60):
        for _ in range(rng.choice([1, 2, 5, 9])):
            rows.append((conv, rng.choice([None, *range(-3, 2 * CHUNK)]),
                         rng.choice(["user", "assistant", "system", "tool", "<|none|>", None, "a" + attacks(rng)]),
                         rng.choice([None, attacks(rng), attacks(rng)])))
    rows += rows[:5]
    df = spark.createDataFrame([(*r, 1) for r in rows], SCHEMA + ", formatted int")
    back = {r.conv_id: [(t.role, t.text) for t in r.turns] for r in read_back(formatted(df)).collect()}
    assert back == {c: plain([r for r in rows if r[0] == c]) for c in range(60)}
    for r in digest(df).collect():
        turns = plain([x for x in rows if x[0] == r.conv_id])
        loss = "".join(t for role, t in turns if role == "assistant")
        assert (r.n_turns, r.loss_chars) == (len(turns), len(loss))
        assert r.loss_sha256 == hashlib.sha256(loss.encode()).hexdigest()
        spelled = "".join(f"{role or ''}\n{t}\n" for role, t in turns)
        assert r.turns_sha256 == hashlib.sha256(spelled.encode()).hexdigest()


def test_adjacent_turns_of_a_role_share_a_block(spark):
    rows = [(1, 0, "user", "a"), (1, CHUNK, "user", "b"), (1, 2 * CHUNK, "assistant", "c"), (1, 2 * CHUNK + 1, "assistant", "d")]
    text = formatted(spark.createDataFrame(rows, SCHEMA)).first().formatted
    assert text == (BEGIN + OPEN["user"] + "a" + TURN + "b" + CLOSE["user"]
                    + OPEN["assistant"] + "c" + TURN + "d" + CLOSE["assistant"])


def test_long_conversation_null_id_and_empty(spark):
    rows = [(7, i, "user" if i % 3 else "assistant", f"t{i} " * 20) for i in range(5 * CHUNK)] + [(None, 1, "user", "x" * 300_000)]
    df = spark.createDataFrame(rows, SCHEMA)
    found = {r.conv_id: r for r in digest(df).collect()}
    assert found[7].n_turns == 5 * CHUNK and found[None].n_turns == 1 and found[None].loss_chars == 0
    assert digest(df.limit(0)).count() == 0


def test_only_built_in_functions(spark):
    plan = digest(spark.createDataFrame([], SCHEMA))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
