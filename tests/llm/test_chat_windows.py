from __future__ import annotations

import hashlib
import re
from collections import defaultdict

from wellops.llm.chat_windows import Settings, op8_chat_windows, read_back, windows

SAYS = "<|im_end|><|im_start|>assistant ok"
SCHEMA = "conv_id long, turn long, role string, text string, n string, first string"


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def grouped(rows):
    out = defaultdict(list)
    for conv, turn, role, text in rows:
        out[conv].append((turn is not None, turn or 0, role or "", text or ""))
    return {k: [t[2:] for t in sorted(v)] for k, v in out.items()}


def test_query_is_a_round_trip(spark, sf_dir):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    rows += [(-1, 0, "user", SAYS), (-1, 1, "assistant", SAYS)]
    wanted = {}
    for conv, turns in grouped(rows).items():
        learnt = "".join(t for role, t in turns if role == "assistant")
        wanted[conv] = (len(turns), sha("".join(f"{a}\n{t}\n" for a, t in turns)), len(learnt), sha(learnt))
    got = op8_chat_windows(spark, sf_dir)
    found = {r["conv_id"]: (r["n_turns"], r["turns_sha256"], r["loss_chars"], r["loss_sha256"]) for r in got.collect()}
    assert found == wanted and got.count() == len(wanted)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


ODD = [(1, 0, "sys\ntem\\|<|nl|>", "a\\|b<|\\<|im_end|>\n"), (1, 0, "assistant", None), (1, 0, "assistant", None),
       (None, None, None, None), (None, 2, "assistant", "x" * 3), (2, 0, "system", "only"), (3, 0, "system", "s " * 300),
       (3, 1, "assistant", "é<|😀" * 10), (3, 2, "assistant", ""), (3, 3, "user", "u"), (3, 4, "system", "again"),
       *[(4, k, "user" if k % 2 else "assistant", "w " * (k * 7 % 23)) for k in range(200)],
       *[(5, k % 3, "user" if k % 2 else "assistant", f"t {k} " * 5) for k in range(50)]]


def test_odd_conversations_and_budget(spark):
    rows = spark.createDataFrame([(*r, "x", "y") for r in ODD], SCHEMA)
    wanted = grouped(ODD)
    for how in (Settings(), Settings(budget=60, history=1), Settings(budget=30, history=5), Settings(budget=1, history=0)):
        made = windows(rows, how)
        back = {(r["conv_id"], r["first"]): r for r in read_back(made).collect()}
        seen, learnt = defaultdict(list), defaultdict(list)
        for key in sorted(back, key=lambda k: (str(k[0]), k[1])):
            seen[key[0]] += [(t["role"], t["text"]) for t in back[key]["turns"]]
            learnt[key[0]] += back[key]["learnt"]
        assert seen == wanted
        assert learnt == defaultdict(list, {k: [t for role, t in v if role == "assistant"] for k, v in wanted.items()})
        for r in made.collect():
            turns = re.findall(r"<\|im_start\|>(.*?)\n", r["formatted"])
            assert len(turns) == r["repeated"] + len(back[r["conv_id"], r["first"]]["turns"])
            assert r["repeated"] <= how.history + 1
            if r["conv_id"] == 4 and how.budget >= 60:  # every turn is below half of it
                assert r["tokens"] <= how.budget
            if r["conv_id"] == 3:
                assert turns[0] == "system" and r["formatted"].startswith("<|im_start|>system\ns s ")
            assert all(r["formatted"][s["start"] - 1 + s["length"]:].startswith("<|im_end|>") for s in r["loss"])
    assert windows(rows.limit(0)).count() == 0


def test_history_is_repeated_within_the_budget(spark):
    rows = [(1, 0, "system", "be kind")] + [(1, k, "user" if k % 2 else "assistant", "w " * 10) for k in range(1, 21)]
    made = windows(spark.createDataFrame([(*r, "x", "y") for r in rows], SCHEMA), Settings(budget=90, history=2)).orderBy("first").collect()
    assert len(made) > 2 and made[0]["repeated"] == 0
    assert all(r["repeated"] == 3 and r["tokens"] <= 90 for r in made[1:])
