from pyspark.sql import functions as F

from tallyweave.llm import preferences


def test_prefix_is_rendered_once_and_masks_cover_assistant_turns(spark):
    rows = [
        (0, 0, "system", "s"), (0, 1, "user", "hi"), (0, 2, "assistant", "good"), (0, 3, "user", "ok"), (0, 4, "assistant", "bye"),
        (1, 0, "system", "s"), (1, 1, "user", "hi"), (1, 2, "assistant", "bad"),
        (2, 0, "user", "a"), (2, 1, None, None), (3, 0, "user", "a"), (3, 1, "", ""), (3, 1, "", ""),
        (4, 0, "user", "alone"), (None, 0, "user", "x"), (6, None, "user", "p"), (7, None, "user", "q"),
    ]
    df = spark.createDataFrame([(*r, "n", "a") for r in rows], "conv_id long, turn long, role string, text string, n string, a string")
    got = {r.pair_id: r for r in preferences.format_preferences(df, F.expr("conv_id div 2"), F.expr("conv_id % 2 = 0")).collect()}
    assert set(got) == {0, 1, 3}
    r = got[0]
    assert r.n_common == 2 and r.prompt == "<|system|>\ns<|end|>\n<|user|>\nhi<|end|>\n"
    assert r.rejected == "<|assistant|>\nbad<|end|>\n"
    assert [r.chosen[s.start : s.end] for s in r.chosen_spans] == ["good<|end|>", "bye<|end|>"]
    assert [r.rejected[s.start : s.end] for s in r.rejected_spans] == ["bad<|end|>"]
    assert (got[1].n_common, got[1].chosen, got[1].rejected) == (2, "", "<||>\n<|end|>\n")
    assert got[3].n_common == 0 and got[3].prompt == ""
    assert preferences.format_preferences(df.where("false"), F.col("conv_id"), F.lit(True)).count() == 0


def test_long_turns_and_conversations(spark):
    long = "é word " * 40_000
    rows = [(0, i, "assistant" if i % 2 else "user", long if i == 1 else f"t{i}") for i in range(300)] + [(1, i, "assistant" if i % 2 else "user", long if i == 1 else f"t{i}" if i < 299 else "other") for i in range(300)]
    df = spark.createDataFrame([(*r, "x") for r in rows], "conv_id long, turn long, role string, text string, pair_id string")
    r = preferences.format_preferences(df, F.lit(0), F.col("conv_id") == 0).first()
    assert r.n_common == 299 and r.prompt.count("<|end|>\n") == 299 and long in r.prompt
    assert (r.chosen, r.rejected) == ("<|assistant|>\nt299<|end|>\n", "<|assistant|>\nother<|end|>\n")
    assert [r.rejected[s.start : s.end] for s in r.rejected_spans] == ["other<|end|>"]
