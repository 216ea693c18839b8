"""Rounds of question writing with clients that repeat, truncate and fall silent."""

import json

import pytest
from pyspark.sql import functions as F

from loamstack.operators.question_rounds import QuestionRounds, checked, reply_state

TASKS = ("discrimination", "description", "counting")


def prompts(spark, tasks=TASKS):
    return spark.createDataFrame([(t, f"task {t}: write {{n}} questions.") for t in tasks], "task string, prompt string")


def seeds(spark):
    return spark.createDataFrame([("discrimination", "请判断图中是否有异常？"), ("description", "请描述图中的状况。")], "task string, question string")


def make_writer():
    """A function of its own, so that it travels to the workers by value."""
    import json
    import re

    def write(prompt, budget, torn=0):
        """As many questions as asked for, after the highest number it is shown; every fourth is colloquial."""
        task, n = re.match(r"task (\w+): write (\d+)", prompt).groups()
        start = max([int(x) for x in re.findall(r"第 (\d+) 号", prompt)], default=0)
        one = "请清点第 {} 号图中的{{defect}}。" if task == "counting" else "请说明第 {} 号图中{{obj}}的状况。"
        asked = [one.format(start + k + 1) if k % 4 else "这玩意有问题吗？" for k in range(int(n))]
        text = json.dumps(asked, ensure_ascii=False)
        return text[: len(text) - torn] if torn else text

    return write


def test_rounds_reach_the_target_and_say_what_is_known(spark, tmp_path):
    run = QuestionRounds(prompts(spark), seeds(spark), str(tmp_path / "q"))
    bank = run.run({"m": make_writer()}, 30, rounds=4, chunk=20, workers=2)
    rows = bank.collect()
    assert {t: sum(r["task"] == t for r in rows) for t in TASKS} == dict.fromkeys(TASKS, 30)
    assert len({(r["task"], r["question"]) for r in rows}) == 90
    asked = run.asked().orderBy("round").collect()
    assert {r["budget"] for r in asked if r["want"] == 20} == {2048} and max(r["round"] for r in asked) <= 3
    assert not any(r["short"] for r in run.report(30).collect()) and run.due(30).count() == 0


def test_one_round_falls_short_and_a_later_run_goes_on(spark, tmp_path):
    run = QuestionRounds(prompts(spark), seeds(spark), str(tmp_path / "q"))
    run.run({"m": make_writer()}, 30, rounds=1, chunk=20, workers=2)
    assert all(r["short"] and r["n"] == 15 for r in run.report(30).collect())
    due = run.due(30, 20).collect()
    assert all("第 19 号" in r["prompt"] and r["want"] == 20 for r in due)
    # The next run reads the state; a round whose last table is missing doesn't count.
    assert QuestionRounds(prompts(spark), seeds(spark), str(tmp_path / "q")).run({"m": make_writer()}, 30, rounds=3, chunk=20, workers=2).count() == 90


def test_torn_answers_are_salvaged_and_asked_for_less(spark, tmp_path):
    run, writer = QuestionRounds(prompts(spark, ("discrimination",)), seeds(spark), str(tmp_path / "q")), make_writer()
    bank = run.run({"m": lambda p, b: writer(p, b, torn=10)}, 10, workers=1)
    assert bank.count() == 10 and {r["outcome"] for r in run.asked().collect()} == {"salvaged"}
    hopeless = QuestionRounds(prompts(spark, ("discrimination",)), seeds(spark), str(tmp_path / "h"))
    assert hopeless.run({"m": lambda p, b: '["请说'}, 10, workers=1).count() == 0
    assert [r["ask"] for r in hopeless.asked().orderBy("round").collect()] == [18, 9, 5]


def test_silence_ends_a_task_and_nothing_else(spark, tmp_path):
    writer = make_writer()
    silent = lambda p, b: "" if "counting" in p else "no list here" if "description" in p else writer(p, b)
    run = QuestionRounds(prompts(spark), seeds(spark), str(tmp_path / "q"))
    run.run({"a": silent, "b": silent}, 10, workers=2)
    assert {r["task"]: (r["n"], r["short"]) for r in run.report(10).collect()} == {"discrimination": (10, False), "description": (0, True), "counting": (0, True)}
    assert {r["task"]: r["outcome"] for r in run.asked().filter("round = 1").collect()} == {"discrimination": "whole", "description": "none", "counting": "silent"}


@pytest.mark.parametrize("text, state", [('x ["a", "b"] y', "whole"), ('["a", "b', "salvaged"), ("[1, ", "torn"), ("words", "none"), ("  ", "silent"), (None, "silent")])
def test_reply_states(spark, text, state):
    assert spark.range(1).select(reply_state(F.lit(text).cast("string")).alias("s")).first()["s"] == state


def test_known_and_repeated_questions_are_refused(spark):
    q = "请判断图中是否有异常？"
    replies = spark.createDataFrame([(1, "discrimination", json.dumps([q, "请查看{obj}有无裂纹？", " 请查看{obj}有无裂纹？ "], ensure_ascii=False)), (2, "description", json.dumps([q], ensure_ascii=False))], "request long, task string, text string")
    got = {(r["task"], r["pos"]): r["reason"] for r in checked(replies, seeds(spark)).collect()}
    assert got == {("discrimination", 0): "repeated", ("discrimination", 1): None, ("discrimination", 2): "repeated", ("description", 0): None}
