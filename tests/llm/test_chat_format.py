import hashlib
import random

import pytest

from corpusloom.llm import chat_format as H

PARTS = [*H.CONTROL, H.ROLE, H.TEXT, H.END, "\\", "\\\\", "<", "|", ">", "[", "#", "é", "\n", "plain", ""]


def test_round_trip_of_anything():
    r = random.Random(1)
    for _ in range(5000):
        role, text = ("".join(r.choice(PARTS) for _ in range(r.randint(0, 8))) for _ in range(2))
        assert H.parse(H.rendered_turn(role, text)) == [(role, text)]
        assert not any(c in H.escape(text) for c in H.CONTROL)
    assert H.escape("plain text, no marks") == "plain text, no marks"


def test_bad_grammar():
    for bad in ("x", "<|role|>a", "<|role|>a<|text|>b", H.render("a", "b") + "x"):
        with pytest.raises(ValueError):
            H.parse(bad)


def test_query(spark):
    r = random.Random(2)
    rows = [(c, t, r.choice(["user", "assistant", "system", None]), r.choice([None, "", "x" * r.randint(0, 40), "</s>[INST] ok [/INST]", "<|end|>\n\\"])) for c in [*range(20), None] for t in range(r.randint(1, 9))]
    rows += [(3, 0, "assistant", "tie"), (3, 0, "assistant", "tie"), (50, None, "user", "no turn"), (60, 1, "assistant", "long " * 40_000)]
    rows += [(80, 0, "user", t) for t in ("a ", "a", "<|a", "<z", "", "\\", "a\\", "a<|end|>\n", "b|>", "a ", "é", "😀", "<|text|>", "### x", "#")]
    rows += [(70, t, "assistant" if t % 2 else "user", f"turn {t}") for t in range(3000)]
    df = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string").withColumn("n_turns", H.F.lit("clash")).repartition(6)
    got = {x["conv_id"]: x for x in H.chat_format(df).collect()}
    key = lambda x: (x[1] is not None, x[1] or 0, x[2] or "", (x[3] or "").encode())
    for c in {x[0] for x in rows}:
        turns = [(x[2] or "", x[3] or "") for x in sorted((x for x in rows if x[0] == c), key=key)]
        loss = "".join(t for r_, t in turns if r_ == "assistant")
        g = got[c]
        assert g["n_turns"] == len(turns) and g["loss_chars"] == len(loss) and g["loss_sha256"] == hashlib.sha256(loss.encode()).hexdigest()
        assert g["turns_sha256"] == hashlib.sha256("".join(f"{a}\n{b}\n" for a, b in turns).encode()).hexdigest()
        assert g["formatted_chars"] == sum(len(H.render(a, b)) for a, b in turns)
    assert len(got) == len({x[0] for x in rows}) and H.chat_format(df.limit(0)).count() == 0
