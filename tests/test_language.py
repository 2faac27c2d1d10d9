"""The controlled task language phrase by phrase, with the expected classes written out."""

import pytest
from pyspark.sql import functions as F

from rigweave.functions import text as T

NARRATIVE, SPECULATIVE, ACTUATOR, EMBODIMENT = "NARRATIVE_OR_SPECULATIVE_PREFIX", "SPECULATIVE_WORDING", "ACTUATOR_NARRATION", "EMBODIMENT_CENTRIC_LANGUAGE"
EVALUATIVE, PRONOUN, MARKDOWN, LENGTH = "EVALUATIVE_WORDING", "UNNAMED_PRONOUN_OBJECT", "MARKDOWN_OR_STRUCTURE", "INSTRUCTION_LENGTH"
CASES = {
    (NARRATIVE,): ("The robot picks a cup", "the robotic tool works", "The arm goes up", "The hand is open", "It appears open", "We can see a cup", "In this image a cup", "in this frame a cup", "In the image a cup", "According to plan", "I think so now",
                   "I guess a cup", "Maybe a cup", "Perhaps a cup", "Probably a cup", "Possibly a cup", "Looks like a cup", "It seems fine"),
    (NARRATIVE, SPECULATIVE): ("Seems like a cup", "It seems to work"),
    (SPECULATIVE,): ("the lid appears to close", "the lid seems to close", "the lid might be shut", "The lid may be shut"),
    (ACTUATOR,): ("Set joint 4", "Read qpos now", "Send qcmd now", "the joints all bend", "Use a servo", "Start the motor", "An actuator works", "Set gripper position", "turn by 5 degrees", "turn by 5 deg", "two radians more", "a 17d state", "a 16-dim state"),
    (EMBODIMENT,): ("Move the robot arm", "rotate hand", "Raise the robotic wrist", "lower the end-effector", "Reach the gripper", "Extend arm"),
    (EVALUATIVE,): ("Place the cup successfully", "Close the lid correctly", "close the lid perfectly", "Carefully close the lid", "slowly close the lid", "precisely close the lid"),
    (PRONOUN,): ("Pick it", "then move them away", "Insert this", "place that there", "Grasp it now", "lift it up", "hold it still", "release it", "press it down"),
    (MARKDOWN,): ("**Pick** the cup", "# Pick the cup", "Pick `cup` now", "pick_cup now", "{pick the cup}", "[pick the cup]", "- pick the cup", "+ pick the cup"),
    (LENGTH,): ("Go", "x" * 161),
    (): ("Pick the cup", "jointly pick the cup", "A motorbike", "pick up items", "x" * 160, "Stop", "successful pick", "Open the arm rest", "move the cup to the arm"),
}
INTENTS = {
    "APPROACH": ("Reach for the cup", "approach the cup"), "ACQUIRE": ("Grasp the cup", "pick the cup", "Pick up a cup", "take one", "receive one", "hold one"), "TRANSPORT": ("Move one", "carry one", "transfer one", "lift one"),
    "ALIGN": ("Align one", "position one", "orient one"), "INSERT_CONNECT": ("Insert one", "plug one", "connect one", "seat one"), "RELEASE": ("Release one", "place one", "set down one"),
    "ACTUATE": ("Press one", "push one", "pull one", "turn one", "open one", "close one")}


def judged(spark, texts, expression):
    df = spark.createDataFrame(list(enumerate(texts)), "i int, t string")
    return [r["x"] for r in df.select("i", expression(F.col("t")).alias("x")).orderBy("i").collect()]


def test_every_phrase(spark):
    flat = [(text, list(classes)) for classes, texts in CASES.items() for text in texts]
    got = judged(spark, [t for t, _ in flat], T.violations)
    assert [(t, g) for (t, _), g in zip(flat, got)] == flat


def test_every_intent(spark):
    flat = [(text, [name]) for name, texts in INTENTS.items() for text in texts] + [("reaching", []), (None, [])]
    got = judged(spark, [t for t, _ in flat], T.intents)
    assert [(t, g) for (t, _), g in zip(flat, got)] == flat


@pytest.mark.parametrize("word", ["joint", "joints", "motor", "motors", "actuator", "servo", "qpos", "qcmd", "radian", "关节", "电机", "执行器"])
def test_every_actuator_word(spark, word):
    assert judged(spark, [f"Check ({word}), then go", "Check jointly"], T.actuator_words) == [[word], []]
