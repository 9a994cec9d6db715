import json

import pytest
from pyspark.sql import functions as F

from taleweave.functions import lexicon as X
from taleweave.functions import text as T
from taleweave.operators import speeches as S


def values(spark, texts, column):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    return [r["v"] for r in df.select("i", column.alias("v")).orderBy("i").collect()]


def test_labelled_pairs(spark):
    got = values(spark, ["level: 5, hp=20; mood: calm\nclass: Rogue", "a: "], T.last_per_key(T.labelled_pairs("t")))
    assert got == [{"level": "5", "hp": "20", "mood": "calm", "class": "Rogue"}, {}]


def test_pairs_are_parts_of_the_pattern(spark):
    """Key and value of a match are the groups of the search itself."""
    import random
    rng = random.Random(3)
    texts = ["".join(rng.choice("ab :=\n\t,;_-\u00e4\u2028") for _ in range(rng.randrange(24))) for _ in range(400)] + [None, "", "a:  ", "ab : \t"]
    def group(i):
        return F.regexp_extract_all("t", F.lit(X.PAIR_PATTERN), F.lit(i))
    pairs = F.zip_with(group(1), group(2), lambda k, v: F.struct(T.key_slug(k).alias("key"), T.strip(v, X.EDGE_PUNCTUATION).alias("value")))
    assert values(spark, texts, T.labelled_pairs("t")) == values(spark, texts, F.filter(pairs, lambda p: p["value"] != ""))


def test_repeated_key_keeps_last(spark):
    assert values(spark, ["hat: red, hat: blue"], T.last_per_key(T.labelled_pairs("t"))) == [{"hat": "blue"}]


def test_numbers(spark):
    got = values(spark, ["level is 7", "lvl: 5", "LEVEL=12 lvl 3", "none", "level 99999999999999"], T.number_after("t", ["level", "lvl"]))
    assert got == [7, 5, 12, None, 2147483647]


def test_json_object(spark):
    texts = ['pre {"a":"}{","b":{"c":1}} post {"z":1}', r'say "hi" {"a":"\"}"} x', "none", "{ open", '} {"k":1}']
    want = ['{"a":"}{","b":{"c":1}}', r'{"a":"\"}"}', None, None, '{"k":1}']
    assert values(spark, texts, T.first_json_object("t")) == want


def _balanced(text):
    start = text.find("{")
    if start < 0:
        return None
    depth, quoted, escaped = 0, False, False
    for i, ch in enumerate(text[start:], start):
        if quoted:
            escaped, quoted = (False, True) if escaped else (ch == "\\", ch != '"')
        elif ch == '"':
            quoted = True
        elif ch in "{}":
            depth += 1 if ch == "{" else -1
            if depth == 0:
                return text[start:i + 1]
    return None


def test_json_object_brute_force(spark):
    import random

    rng = random.Random(3)
    texts = ["".join(rng.choice('{}"\\a ') for _ in range(rng.randint(0, 24))) for _ in range(400)]
    assert values(spark, texts, T.first_json_object("t")) == [_balanced(t) for t in texts]


def test_title(spark):
    texts = ["o'neil half-orc", "ROGUE 3rd", "", "élan vital"]
    assert values(spark, texts, T.title("t")) == [t.title() for t in texts]


@pytest.mark.parametrize("said,want", [
    ("Liora from Waterdeep with silver eyes", "Liora"), ("named mira ashveil the great one", "Mira Ashveil The"),
    ("  'Bryn', the bold", "Bryn'"), ("42", None)])
def test_clean_name(spark, said, want):
    assert values(spark, [said], T.clean_name("t")) == [want]


def test_name_hint(spark):
    assert values(spark, ["ein Elf namens Arno", "a man called Bob who fights", "x"], T.name_hint("t")) == ["Arno", "Bob", None]


def test_answers(spark):
    texts = ["… [ANSWER] juliet [END] x", "… [ANSWER]  king  richard iii", "no marker", "… [ANSWER] [END]"]
    assert values(spark, texts, T.extract_answer("t")) == ["juliet", "king  richard iii", None, ""]
    assert values(spark, texts, T.norm_label(T.extract_answer("t"))) == ["JULIET", "KING RICHARD III", None, ""]
    assert values(spark, ["[SPEAKER] hi [ANSWER] ROMEO [END]"], T.prompt_of("t")) == ["[SPEAKER] hi [ANSWER] "]


def test_syllables(spark):
    texts = ["the", "table", "rhythm", "beauteous", "--", "See him pluck Aufidius down by the hair,"]
    assert values(spark, texts, T.syllables("t")) == [1, 1, 1, 2, 0, 10]


def test_slug_and_phrase(spark):
    assert values(spark, ["Multi-task A+B"], T.slug("t")) == ["multi_task_a_b"]
    assert values(spark, ["Half-Elf's  Bow!"], T.norm_phrase("t")) == ["half elf's bow"]


def test_stringify(spark):
    assert values(spark, ['["a", " b ", ""]', " x ", "7"], T.stringify_json("t")) == ["a, b", "x", "7"]


def test_strip_inside_arrays(spark):
    df = spark.createDataFrame([("a|  b | ",)], "t string")
    from taleweave.operators.relational import list_items

    assert df.select(list_items("t").alias("v")).first()["v"] == ["a", "b"]


def test_headers(spark):
    lines = ["First Citizen:", "KING RICHARD III:", "Rome", "Lord-Mayor", "O'er the", "of Rome", "McDuff", "a", "ACT.", ""]
    assert values(spark, lines, S.is_header("t")) == [True] * 4 + [False] * 6


PLAY = """First Citizen:
Before we proceed any further, hear me speak out.
[aside]
And   hear me well.

lost line after a blank
SECOND MAN.
Too short.
THIRD MAN:
This speech is certainly long enough to keep."""


def test_speeches(spark):
    df = spark.createDataFrame([(1, PLAY), (2, PLAY.replace("\n", "\r\n"))], "doc_id long, text string")
    rows = S.parse_speeches(df).orderBy("doc_id", "speech_no").collect()
    assert [(r["doc_id"], r["speaker"], r["num_lines"]) for r in rows] == [
        (d, s, n) for d in (1, 2) for s, n in (("FIRST CITIZEN", 2), ("THIRD MAN", 1))]
    assert rows[0]["lines"] == ["Before we proceed any further, hear me speak out.", "And hear me well."]


def test_blocks_of_one_file_give_the_same_speeches(spark, tmp_path):
    from taleweave.sources.readers import read_corpus, read_corpus_blocks

    text = "\n\n".join(PLAY.replace("Citizen", f"Citizen {'ABCDEFGH'[i]}") for i in range(8))
    (tmp_path / "play.txt").write_text(text)
    whole = S.parse_speeches(read_corpus(spark, str(tmp_path)), "path")
    blocks = S.parse_speeches(read_corpus_blocks(spark, str(tmp_path)), ["path", "offset", "block"])
    pick = lambda df: sorted((r["speaker"], r["speech_text"]) for r in df.collect())
    assert pick(whole) == pick(blocks) and len(pick(whole)) == 16


def test_verse_and_prose(spark):
    verse = [
        ["See him pluck Aufidius down by the hair,", "As children from a bear, the Volsces shunning him:",
         "Methinks I see him stamp thus, and call thus:"],
        ["Following the fliers at the very heels,", "With them he enters; who, upon the sudden,",
         "Clapp'd to their gates: he is himself alone,", "To answer all the city."]]
    prose = [["A line that is quite long enough to be prose here,", "and another line that goes on in the same way,",
              "and a last one that ends the whole paragraph now."]]
    df = spark.createDataFrame([(v,) for v in verse + prose + [["One.", "Two."]]], "lines array<string>")
    assert [r[0] for r in df.select(S.classify_speech("lines")).collect()] == ["VERSE", "VERSE", "PROSE", None]


def test_examples_file(spark, tmp_path):
    from taleweave.sources.readers import read_examples

    (tmp_path / "test.txt").write_text("[SPEAKER] one\ntwo [ANSWER] ROMEO [END]\n[CLASSIFY] x [ANSWER] VERSE [END]")
    rows = read_examples(spark, str(tmp_path)).orderBy("task").collect()
    assert [(r["task"], r["label"], r["input_text"]) for r in rows] == [("A", "ROMEO", "one\ntwo"), ("B", "VERSE", "x")]


def test_json_members(spark):
    assert json.loads(values(spark, ['x {"a": {"b": 1}}'], T.parse_object(T.first_json_object("t")))[0]["a"]) == {"b": 1}
    assert values(spark, ["{bad}"], T.parse_object("t")) == [None]
    assert spark.range(1).select(F.lit(1)).first()[0] == 1
