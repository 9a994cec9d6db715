from difflib import SequenceMatcher

import pytest
from pyspark.sql import functions as F

from taleweave.functions import lexicon as X
from taleweave.functions import records as RF
from taleweave.operators import create
from taleweave.operators import dialogue as D
from taleweave.operators import evaluate as E
from taleweave.operators import extract, landing, matching, profile, render
from taleweave.operators import registry as G

TERMS = [("race", "Elf"), ("race", "Half-Elf"), ("race", "Human"), ("primary_class", "Rogue"), ("primary_class", "Fighter"),
         ("primary_class", "Ranger"), ("background", "Noble"), ("background", "Criminal"), ("subclass", "Thief"),
         ("subclass", "Eldritch Knight"), ("weapon", "Rapier"), ("weapon", "Longsword +1"), ("weapon", "Longbow")]


@pytest.fixture(scope="module")
def terms(spark):
    return spark.createDataFrame(TERMS, "field string, term string")


@pytest.fixture(scope="module")
def owners(spark):
    return spark.createDataFrame([("eldritch knight", "Fighter"), ("thief", "Rogue")], "name string, owner string")


def found(df):
    out = {}
    for r in df.collect():
        out.setdefault(r[0], {})[r["field"]] = r["value"]
    return out


def test_extract(spark, terms, owners):
    docs = spark.createDataFrame([
        (1, "elf rogue named Mira level 7 hp 42 weapon rapier chaotic good suspicious"),
        (2, "human eldritch knight noble wielding longsword +1 eye_color: amber hometown: Waterdeep"),
        (3, "subclass: thief; class: ranger; lvl: 5; mood: Odd"), (4, "class: ranger, archetype: thief")], "doc_id long, text string")
    got = found(extract.extract_fields(docs, terms, owners))
    assert got[1] == {"race": "Elf", "primary_class": "Rogue", "name": "Mira", "level": "7", "hp": "42", "weapon": "Rapier",
                      "alignment": "Chaotic Good", "emotional_state": "suspicious"}
    assert got[2] == {"race": "Human", "primary_class": "Fighter", "subclass": "Eldritch Knight", "background": "Noble",
                      "weapon": "Longsword +1", "trait:eye_color": "amber", "trait:hometown": "Waterdeep"}
    assert got[3] == {"subclass": "Thief", "primary_class": "Ranger", "level": "5", "trait:lvl": "5", "emotional_state": "odd"}
    assert got[4]["primary_class"] == "Ranger" and got[4]["trait:archetype"] == "thief"


def test_containment(spark):
    docs = spark.createDataFrame([(1, "a half-elf rogue"), (2, "a half elf"), (3, "selfish"), (4, "élf"), (5, "an ELF.")], "doc_id long, text string")
    terms = spark.createDataFrame([("race", "Elf"), ("other", "Half-Elf")], "field string, term string")
    assert found(matching.match_dictionary(docs, terms)) == {
        1: {"race": "Elf", "other": "Half-Elf"}, 2: {"race": "Elf"}, 5: {"race": "Elf"}}


def test_containment_in_short_and_long_texts(spark, monkeypatch):
    rows = [(1, "a half-elf rogue"), (1, "a half elf"), (None, "a half-elf, an elf"), (4, None), (5, "half-elf of the half elf")]
    docs = spark.createDataFrame([(k, None if t is None else t + " x" * n) for k, t in rows for n in (0, 4000)], "doc_id long, text string")
    terms = spark.createDataFrame([("race", "Elf"), ("other", "Half-Elf")], "field string, term string")
    want = {1: {"race": "Elf", "other": "Half-Elf"}, None: {"race": "Elf"}, 5: {"race": "Elf", "other": "Half-Elf"}}
    assert found(matching.match_dictionary(docs, terms)) == want
    monkeypatch.setattr(matching, "FEW_TERMS", 0)
    assert found(matching.match_dictionary(docs, terms)) == want


def test_extraction_searches_pairs_once(spark, terms, owners):
    docs = spark.createDataFrame([(1, "eye_color: amber")], "doc_id long, text string")
    plan = extract.extract_fields(docs, terms, owners)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count(X.PAIR_PATTERN) == 1


def test_labels_in_any_case(spark, terms, owners):
    """A text that is not searched for a label does not hold it in any case."""
    texts = ["\u017ftr 5 LEVEL 3", "H\u0130T PO\u0131NTS = 7", "qu\u0131r\u212a is odd", "\u017fecret lies", "GOAL: Gold", "W\u0131eld\u017f a Pike", "h\u0131t po\u0131nt 4"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    said = found(extract._said(docs, "doc_id", "text"))
    assert said == {0: {"str": "5", "level": "3"}, 1: {"hp": "7"}, 2: {"quirk": "odd"}, 3: {"secret": "lies"}, 4: {"goal": "Gold"},
                    5: {"weapon_said": "Pike"}, 6: {"hp": "4"}}


def test_fuzzy_brute_force(spark):
    """The blocked join gives every pair that the plain double loop gives."""
    import random

    rng = random.Random(5)
    base = ["longsword", "rapier", "quarterstaff", "half elf", "human", "rogue", "eldritch knight", "mace", "aab", "aaaa"]
    typed = {b[:i] + rng.choice(["", "x", b[-1]]) + b[i + rng.randint(0, 2):] for b in base for i in range(len(b))} | set(base)
    for cutoff in (0.7, 0.79, 0.84):
        phrases = spark.createDataFrame([(t,) for t in sorted(typed) if t], "phrase string")
        options = spark.createDataFrame([(b, cutoff) for b in base], "option string, cutoff double")
        got = {(r["phrase"], r["option"]) for r in matching.score_phrases(phrases, options).collect()}
        want = {(p, o) for p in typed if p for o in base if p == o or SequenceMatcher(None, p, o).ratio() > cutoff}
        assert got == want


def test_fuzzy_cutoffs(spark, terms, owners):
    docs = spark.createDataFrame([(1, "humen rogeu named Mira weilding rapiar")], "doc_id long, text string")
    nothing = spark.createDataFrame([], "doc_id long, field string, value string")
    assert found(extract.infer_fuzzy(docs, terms, nothing, owners)) == {}
    low = {f: 0.79 for f in X.FUZZY_CUTOFFS}
    got = found(extract.infer_fuzzy(docs, terms, nothing, owners, cutoffs=low))[1]
    assert got == {"race": "Human", "primary_class": "Rogue", "weapon": "Rapier"}
    known = spark.createDataFrame([(1, "race", "Elf")], "doc_id long, field string, value string")
    assert "race" not in found(extract.infer_fuzzy(docs, terms, known, owners, cutoffs=low))[1]


def test_match_value(spark):
    terms = spark.createDataFrame([("race", "Half-Elf"), ("race", "Human"), ("race", "Elf")], "field string, term string")
    values = spark.createDataFrame([("race", v) for v in ("HUMAN", "el", "humann", "orc", "a half elf lord")], "field string, given string")
    got = {r["given"]: r["value"] for r in matching.match_value(values, terms, 0.82).collect()}
    assert got == {"HUMAN": "Human", "el": "Half-Elf", "humann": "Human", "a half elf lord": "Half-Elf"}


def test_landing(spark, terms):
    docs = spark.createDataFrame([
        (1, 'ok {"name": "Liora from Waterdeep", "class": "ranger", "HP": "x", "mood": "", "extra_traits": {"Eye Color": "silver"}, "tags": ["a", "b"]}'),
        (2, "no json"), (3, '{"a": }')], "doc_id long, text string")
    explicit = spark.createDataFrame([(1, "primary_class", "Rogue")], "doc_id long, field string, value string")
    landed, rejects = landing.land_responses(docs, terms, explicit)
    assert found(landed)[1] == {"name": "Liora", "primary_class": "Rogue", "trait:eye_color": "silver", "trait:tags": "a, b"}
    assert {r["doc_id"]: r["reason"] for r in rejects.collect()} == {2: "no object", 3: "invalid json"}


RAW = [
    ("Wood Elf", "Elf", "Rogue", "Thief", "Rapier|Dagger", "Criminal", "CG", "9", "12", "42", "15", "7"),
    ("Human", "NA", "Fighter|Wizard", "Eldritch Knight|Evocation", "Longsword +1", "Noble", "N", "16", "14", "60", "18", "8"),
    ("Human", "Human", "Fighter", "NA", "NA", "Soldier", "XX", "bad", "13", "30", "16", "3"),
    ("NA", "NA", "Cleric", "Life Domain", "Mace", "Acolyte", "LG", "12", "11", "20", "14", "2"),
    ("Elf", "Elf", "Ranger", "Hunter", "Longbow", "Outlander", "NG", "11", "12", "35", "14", "5")]
HEAD = "race;processedRace;justClass;subclass;weapons;background;processedAlignment;Str;Con;HP;AC;level".split(";")


@pytest.fixture(scope="module")
def characters(spark, tmp_path_factory):
    from taleweave.sources.readers import read_characters

    folder = tmp_path_factory.mktemp("chars")
    lines = [";".join(HEAD + ["Dex", "Int", "Wis", "Cha", "no"])] + [";".join([*r, "10", "10", "10", "10", str(i)]) for i, r in enumerate(RAW)]
    (folder / "c.csv").write_text("\n".join(lines))
    return profile.clean_characters(read_characters(spark, str(folder)))


def test_profile(characters):
    assert characters.count() == 4
    dist = {r["value"]: r["p"] for r in profile.alignment_dist(characters).collect()}
    assert dist == {"CG": pytest.approx(1 / 3), "N": pytest.approx(1 / 3), "NG": pytest.approx(1 / 3)}
    assert [r["value"] for r in profile.known_items(characters, "weapons").collect()] == ["Dagger", "Longbow", "Longsword +1", "Rapier"]
    assert [r["value"] for r in profile.known_values(characters, "race_clean").collect()] == ["Elf", "Human"]
    owners = {r["name"]: r["owner"] for r in profile.subclass_to_class(characters, "no").collect()}
    assert owners["evocation"] == "Wizard" and owners["thief"] == "Rogue" and owners["zealot"] == "Barbarian" and "na" not in owners
    params = {(r["primary_class"], r["stat"]): r for r in profile.stat_params(characters).collect()}
    assert params["Ranger", "str"]["std"] is None and params["Fighter", "str"]["mean"] == 16.0
    none = profile.alignment_dist(characters.where("processedAlignment = 'XX'")).collect()
    assert [(r["value"], r["p"]) for r in none] == [("NG", 1.0)]


def test_synthesis(spark, characters):
    learned = profile.Learned(characters)
    over = spark.createDataFrame([(3, "Orc", 99)], "id long, race string, level int")
    made = profile.synthesise_n(spark, learned, 300, 11, overrides=over)
    rows = {r["id"]: r for r in made.collect()}
    again = {r["id"]: r for r in profile.synthesise(spark.range(300).repartition(7), learned, 11, overrides=over).collect()}
    assert rows == again and len(rows) == 300
    assert rows[3]["race"] == "Orc" and rows[3]["level"] == 20
    for r in rows.values():
        assert all(1 <= r[s] <= 20 for s in X.STATS) and 1 <= r["level"] <= 20 and 5 <= r["ac"] <= 30 and 1 <= r["hp"] <= 999
        assert r["alignment"] in X.ALIGNMENTS and r["subclass"] in X.SUBCLASSES[r["primary_class"]]
    seen = {r["race"] for r in rows.values()}
    assert seen == {"Elf", "Human", "Orc"}


def test_tables_of_prompts_are_not_broadcast(spark, terms, owners, characters):
    """What has a row for each prompt is joined by sorted key, however small its files are."""
    prompts = spark.createDataFrame([
        (1, "elf rogue named Mira level 7 hp 42 weapon rapier chaotic good; eye_color: amber"), (2, "humn fihgter"), (3, None)],
        "doc_id long, text string")
    made = create.create_records(prompts, profile.Learned(characters), terms, owners, 11)
    nothing = spark.createDataFrame([], "doc_id long, field string, value string")
    repaired = extract.infer_fuzzy(prompts, terms, nothing, owners)
    for df in (made, repaired):
        assert "BroadcastHashJoin [doc_id" not in df._jdf.queryExecution().executedPlan().toString()
    rows = {r["seq"]: r for r in made.collect()}
    assert sorted(rows) == [1, 2, 3]
    assert (rows[1]["name"], rows[1]["race"], rows[1]["level"], rows[1]["extra_traits"]) == ("Mira", "Elf", 7, {"eye_color": "amber"})


def test_record_texts(spark):
    hero = G.conform(spark.createDataFrame([("Test Hero", 16, 5, "x", "hm")], "name string, str int, level int, junk string, emotional_state string"), "name")
    row = hero.select("*", RF.stat_block().alias("b"), F.size("notes").alias("n")).first()
    assert row["story"] == "" and row["goal"] == "" and row["n"] == 0 and row["race"] == "Human"
    assert row["b"].startswith("STR 16  DEX 10") and len(row["npc_id"]) == 8
    assert hero.select(render.persona_prompt(hero)).first()[0].startswith("You are Test Hero, a Human Fighter")


def test_registry_roundtrip(spark, tmp_path):
    import json

    from taleweave.sources import readers, writers

    rows = [{"npc_id": "a", "name": "One", "HP": 7}, {"npc_id": "b", "name": "Two", "hat": 1}, {"npc_id": "a", "name": "Three", "HP": 9}]
    for kind, body in (("list", rows), ("object", {"npcs": rows})):
        (tmp_path / f"{kind}.json").write_text(json.dumps(body, indent=2))
        got = readers.read_registry(spark, str(tmp_path / f"{kind}.json")).orderBy("seq").collect()
        assert [(r["npc_id"], r["name"], r["hp"]) for r in got] == [("a", "Three", 9), ("b", "Two", 10)]
    (tmp_path / "bad.json").write_text("{oops")
    assert readers.read_registry(spark, str(tmp_path / "bad.json")).count() == 0
    table = str(tmp_path / "table")
    assert readers.read_registry_table(spark, table).count() == 0
    registry = readers.read_registry(spark, str(tmp_path / "list.json"))
    writers.write_registry(registry, table)
    assert writers.write_registry(G.remove(registry, spark.createDataFrame([("a",)], "npc_id string")), table) == 1
    assert [r["npc_id"] for r in readers.read_registry_table(spark, table).collect()] == ["b"]


def test_resolve_and_edit(spark):
    registry = G.conform(spark.createDataFrame([("aa", "Mira", 5), ("bb", "mira", 9), ("77", "Seven", 12)], "npc_id string, name string, seq long"))
    refs = spark.createDataFrame([(r,) for r in ("1", "9", "MIRA", "bb", "BB", "77", " 2 ", "zz")], "ref string")
    got = {r["ref"]: r["npc_id"] for r in G.resolve(refs, registry).collect()}
    assert got == {"1": "aa", "9": None, "MIRA": "aa", "bb": "bb", "BB": "bb", "77": None, " 2 ": "bb", "zz": None}
    edits = spark.createDataFrame([("aa", 1, "level", "9"), ("aa", 2, "level", "nine"), ("aa", 3, "notes", "a, b,,c"), ("aa", 4, "hat", "red")],
                                  "npc_id string, seq long, field string, value string")
    edited, rejects = G.apply_edits(registry, edits)
    row = edited.where("npc_id = 'aa'").first()
    assert row["level"] == 9 and row["notes"] == ["a", "b", "c"]
    assert sorted((r["field"], r["reason"]) for r in rejects.collect()) == [("hat", "unknown field"), ("level", "expects a number")]


def test_upsert_is_idempotent(spark):
    base = spark.createDataFrame([("a", "x", 1), ("b", "y", 2)], "npc_id string, name string, seq long")
    new = spark.createDataFrame([("b", "z", 3), ("c", "w", 4), ("c", "v", 5)], "npc_id string, name string, seq long")
    once = G.upsert(base, new)
    want = [("a", "x", 1), ("b", "z", 2), ("c", "v", 4)]
    assert sorted(map(tuple, once.select("npc_id", "name", "seq").collect())) == want
    assert sorted(map(tuple, G.upsert(once, new).select("npc_id", "name", "seq").collect())) == want


@pytest.mark.parametrize("said,want", [
    ("hello", "greeting"), ("this is odd", "greeting"), ("goodbye", "farewell"), ("who are you?", "who"), ("any job for me", "quest"),
    ("a battle looms", "fight"), ("I want to buy rope", "trade"), ("which road", "greeting"), ("nearest town", "info"),
    ("I will hurt you", "threat"), ("well done", "compliment"), ("umm", "generic")])
def test_intent(spark, said, want):
    assert spark.createDataFrame([(said,)], "t string").select(D.intent("t")).first()[0] == want


def test_history_cap(spark):
    turns = spark.createDataFrame([(1, t, "user", f"t{t}") for t in range(30)], "conv_id long, turn long, role string, text string")
    history = D.bounded_history(turns).first()["history"]
    assert [h["content"] for h in history] == [f"t{t}" for t in range(6, 30)]


def test_replies_follow_the_persona(spark):
    people = [("Fighter", "Neutral Good", "fight", ["Combat?"]), ("Bard", "Chaotic Evil", "greeting", ["...*eyes", "You address"]),
              ("Bard", "Chaotic Good", "greeting", ["Ha!", "*spins"]), ("Barbarian", "Lawful Evil", "threat", ["*smiles"]),
              ("Barbarian", "Lawful Good", "threat", ["*stands"])]
    df = spark.createDataFrame([(i, "Ann", c, a, n) for i, (c, a, n, _) in enumerate(people)], "id long, name string, primary_class string, alignment string, intent string")
    got = {r["id"]: r["r"] for r in df.select("id", D.reply(df, 1, "id").alias("r")).collect()}
    for i, (_, _, _, starts) in enumerate(people):
        assert any(got[i].startswith(s) for s in starts)


def test_accuracy(spark):
    rows = [("… [ANSWER] juliet [END] x", "JULIET"), ("… [ANSWER]  king  richard iii", "KING RICHARD III"), ("no marker", "ROMEO"), ("… [ANSWER] [END]", "ROMEO")]
    judged = E.judged(spark.createDataFrame(rows, "generated string, label string"))
    assert E.accuracy(judged).first()["accuracy"] == 0.5
    assert E.accuracy(judged.where("false")).first()["accuracy"] == 0.0


def test_failing_scorer_gives_null(spark):
    df = spark.createDataFrame([("p",)], "prompt string")

    def broken(prompts):
        raise RuntimeError("no model")

    assert E.score(df, broken).first()["generated"] is None
