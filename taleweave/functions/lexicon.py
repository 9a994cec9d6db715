"""Word lists, templates and patterns that decide query results.

Everything here is data, kept in natural order. Nothing in this module reads a
table or touches Spark.
"""

# --- fixed values: record fields -------------------------------------------
TEXT_FIELDS = [
    "name", "race", "primary_class", "subclass", "background", "alignment",
    "emotional_state", "weapon", "goal", "quirk", "secret",
]
NUMBER_FIELDS = ["level", "hp", "ac", "str", "dex", "con", "int", "wis", "cha"]
STATS = ["str", "dex", "con", "int", "wis", "cha"]

ALIGNMENTS = [
    "Lawful Good", "Neutral Good", "Chaotic Good",
    "Lawful Neutral", "True Neutral", "Chaotic Neutral",
    "Lawful Evil", "Neutral Evil", "Chaotic Evil",
]
ALIGNMENT_CODES = {
    "LG": "Lawful Good", "NG": "Neutral Good", "CG": "Chaotic Good",
    "LN": "Lawful Neutral", "N": "True Neutral", "CN": "Chaotic Neutral",
    "LE": "Lawful Evil", "NE": "Neutral Evil", "CE": "Chaotic Evil",
}
EMOTIONAL_STATES = [
    "friendly", "hostile", "cynical", "trustful", "suspicious", "curious",
    "hopeful", "grieving", "anxious", "calm", "proud",
]

# Defaults of a conformed record.
RECORD_DEFAULTS = {
    "name": "Unknown Wanderer", "race": "Human", "primary_class": "Fighter",
    "subclass": "Veteran", "background": "Outlander", "alignment": "True Neutral",
    "emotional_state": "curious", "weapon": "Longsword",
    "level": 1, "hp": 10, "ac": 10,
    "str": 10, "dex": 10, "con": 10, "int": 10, "wis": 10, "cha": 10,
    "story": "", "goal": "", "quirk": "", "secret": "", "source_prompt": "",
}

# Final clamps (low, high) of a synthesised record.
CLAMPS = {
    "level": (1, 20), "hp": (1, 999), "ac": (5, 30),
    "str": (1, 20), "dex": (1, 20), "con": (1, 20),
    "int": (1, 20), "wis": (1, 20), "cha": (1, 20),
}

# --- fixed values: synthesis -----------------------------------------------
FIRST_NAMES = [
    "Aldric", "Mira", "Theron", "Seraphina", "Gruff", "Lyra", "Borin", "Elara",
    "Torvin", "Nessa", "Drakon", "Sylvara", "Garett", "Isolde", "Bryn", "Cassian",
    "Hilda", "Fenwick", "Zara", "Oswin", "Petra", "Colt", "Wren", "Dagmar",
    "Rook", "Elowen", "Vance", "Sable", "Jasper", "Imara",
]
LAST_NAMES = [
    "Stonebrew", "Ashveil", "Ironforge", "Brightwater", "Coldmere", "Thornwood",
    "Duskmantle", "Silverbell", "Grimshaw", "Oakenshield", "Blackthorn", "Meadowlark",
    "Ravenscar", "Goldenleaf", "Embercroft", "Nighthollow", "Stormridge", "Fairweather",
    "Deepwater", "Cinderheart",
]
SUBCLASSES = {
    "Fighter": ["Champion", "Battle Master", "Eldritch Knight", "Cavalier"],
    "Rogue": ["Thief", "Arcane Trickster", "Assassin", "Swashbuckler"],
    "Cleric": ["Life Domain", "Light Domain", "War Domain", "Tempest Domain"],
    "Barbarian": ["Berserker", "Totem Warrior", "Zealot", "Ancestral Guardian"],
    "Paladin": ["Oath of Devotion", "Oath of Vengeance", "Oath of Glory", "Oathbreaker"],
    "Ranger": ["Hunter", "Beast Master", "Gloom Stalker", "Fey Wanderer"],
    "Wizard": ["Evocation", "Abjuration", "Illusion", "Divination"],
    "Druid": ["Circle of the Moon", "Circle of the Land", "Circle of Stars", "Circle of Spores"],
    "Monk": ["Way of Shadow", "Way of Mercy", "Way of the Open Hand", "Way of the Kensei"],
    "Bard": ["College of Lore", "College of Valor", "College of Glamour", "College of Swords"],
    "Sorcerer": ["Draconic Bloodline", "Wild Magic", "Shadow Magic", "Storm Sorcery"],
    "Warlock": ["The Fiend", "The Archfey", "The Great Old One", "The Hexblade"],
}
SUBCLASS_DEFAULT = ["Wanderer"]
WEAPONS = {
    "Fighter": ["Longsword", "Spear", "Warhammer", "Greatsword"],
    "Rogue": ["Dagger", "Rapier", "Shortbow", "Hand Crossbow"],
    "Cleric": ["Mace", "Warhammer", "Quarterstaff", "Flail"],
    "Barbarian": ["Greataxe", "Maul", "Handaxe", "Greatclub"],
    "Paladin": ["Longsword", "Warhammer", "Glaive", "Morningstar"],
    "Ranger": ["Longbow", "Shortsword", "Dual Daggers", "Spear"],
    "Wizard": ["Quarterstaff", "Wand", "Spellbook", "Crystal Focus"],
    "Druid": ["Oak Staff", "Sickle", "Moon-Touched Spear", "Thorn Whip"],
    "Monk": ["Bo Staff", "Shortsword", "Nunchaku", "Kensei Blade"],
    "Bard": ["Rapier", "Lute", "Violin Bow", "Whip"],
    "Sorcerer": ["Arcane Focus", "Dagger", "Rune Staff", "Crystal Orb"],
    "Warlock": ["Hexblade", "Rod", "Pact Dagger", "Eldritch Tome"],
}
WEAPON_DEFAULT = ["Longsword"]
GOALS = [
    "protect a loved one", "restore a damaged reputation", "map an uncharted ruin",
    "find a lost heirloom", "prove their worth", "make peace with an old mistake",
    "keep dangerous knowledge hidden",
]
QUIRKS = [
    "collects tiny trophies from every city visited",
    "never sits with their back to a door",
    "speaks in half-whispers when nervous",
    "taps their weapon when thinking",
    "quotes old proverbs at odd moments",
    "writes down every promise they hear",
]
SECRETS = [
    "owes a favor to the wrong person",
    "is hiding a forbidden magical talent",
    "forged part of their identity years ago",
    "knows more about a local crime than they admit",
    "is searching for someone who vanished without explanation",
]

# --- fixed values: per-class detail phrases --------------------------------
GOAL_PHRASES = {
    "Barbarian": "make sure their people are never cornered again",
    "Bard": "turn one buried truth into a story nobody can ignore",
    "Cleric": "find where their faith is needed before it arrives too late",
    "Druid": "keep an old place from being stripped of what makes it sacred",
    "Fighter": "finish a duty others quietly abandoned",
    "Monk": "master the impulse that still threatens their discipline",
    "Paladin": "prove their oath still means something in a compromised world",
    "Ranger": "keep a dangerous route out of the wrong hands",
    "Rogue": "get ahead of the danger closing in around them",
    "Sorcerer": "understand the force inside them before it answers for them",
    "Warlock": "untangle a bargain before its cost reaches someone else",
    "Wizard": "decode a piece of magic no one else has understood",
}
GOAL_PHRASE_DEFAULT = "settle a piece of unfinished business before it catches up with them"
QUIRK_PHRASES = {
    "Barbarian": "tests the weight of anything they might need as a weapon",
    "Bard": "quietly rewrites conversations into better dialogue later",
    "Cleric": "touches a charm or symbol before answering difficult questions",
    "Druid": "notices weather shifts before anyone else comments on them",
    "Fighter": "checks the balance of objects in one hand while thinking",
    "Monk": "slows their breathing on purpose whenever tension rises",
    "Paladin": "straightens small signs of disorder without noticing",
    "Ranger": "marks routes and landmarks on any scrap of paper nearby",
    "Rogue": "maps exits before letting their guard down",
    "Sorcerer": "lets small traces of magic leak through strong emotions",
    "Warlock": "pauses a second too long before naming old promises",
    "Wizard": "murmurs fragments of theory under their breath while thinking",
}
QUIRK_PHRASE_DEFAULT = "goes noticeably still before making important decisions"
SECRET_PHRASES = {
    "Barbarian": "they left someone behind when retreat was the only way out",
    "Bard": "one of their most famous stories is closer to confession than performance",
    "Cleric": "they are still waiting for an answer they once swore they already received",
    "Druid": "an ancient place still recognizes them for something they regret",
    "Fighter": "the battle that made their reputation also left a truth buried",
    "Monk": "their calm was built around a mistake they never made peace with",
    "Paladin": "their oath began with a compromise no one else knows about",
    "Ranger": "they are tracking someone for reasons they refuse to explain",
    "Rogue": "they kept proof from a job that should have disappeared years ago",
    "Sorcerer": "their power first surfaced during a moment they never describe",
    "Warlock": "the price of their pact is already closer than they admit",
    "Wizard": "they learned one forbidden thing and have never truly set it down",
}
SECRET_PHRASE_DEFAULT = "someone from their past would recognize them for the wrong reason"
QUIET_GOAL_MOODS = ["anxious", "suspicious", "grieving"]
OPEN_QUIRK_MOODS = ["proud", "friendly"]

# --- fixed values: field aliases -------------------------------------------
# keys of `key: value` pairs found in free text
PAIR_ALIASES = {
    "hp": "hp", "hit_points": "hp", "ac": "ac", "armor_class": "ac",
    "class": "primary_class",
    "str": "str", "strength": "str", "dex": "dex", "dexterity": "dex",
    "con": "con", "constitution": "con", "int": "int", "intelligence": "int",
    "wis": "wis", "wisdom": "wis", "cha": "cha", "charisma": "cha",
    "emotion": "emotional_state", "emotion_state": "emotional_state",
    "mood": "emotional_state",
}
# keys of JSON payloads
PAYLOAD_ALIASES = {
    "hp": "hp", "ac": "ac", "str": "str", "dex": "dex", "con": "con",
    "int": "int", "wis": "wis", "cha": "cha",
    "class": "primary_class", "archetype": "subclass",
    "mood": "emotional_state", "emotion": "emotional_state",
    "hit_points": "hp", "armor_class": "ac",
    "strength": "str", "dexterity": "dex", "constitution": "con",
    "intelligence": "int", "wisdom": "wis", "charisma": "cha",
    "backstory": "story",
}
STAT_WORDS = {
    "str": ["str", "strength"], "dex": ["dex", "dexterity"],
    "con": ["con", "constitution"], "int": ["int", "intelligence"],
    "wis": ["wis", "wisdom"], "cha": ["cha", "charisma"],
}

# --- fixed values: patterns over free text ---------------------------------
VALUE_STOP_WORDS = [
    "level", "lvl", "hp", "hit", "ac", "armor", "weapon", "subclass",
    "archetype", "background", "alignment", "race", "class", "goal",
    "quirk", "secret", "str", "dex", "con", "int", "wis", "cha",
    "lawful", "neutral", "chaotic", "friendly", "hostile", "cynical",
    "trustful", "suspicious", "curious", "hopeful", "grieving", "anxious",
    "calm", "proud",
]
NAME_STOP_WORDS = [
    "with", "who", "from", "wields", "wielding", "uses", "using", "wears",
    "wearing", "carries", "carrying", "level", "hp", "ac", "background",
    "alignment", "weapon", "class", "race", "goal", "quirk", "secret",
]
PAIR_PATTERN = (
    r"([A-Za-z][A-Za-z _-]{1,30})\s*[:=]\s*(.+?)"
    r"(?=\s+[A-Za-z][A-Za-z _-]{1,30}\s*[:=]|[,;\n]|$)"
)
# key and value of one such match
PAIR_PARTS = r"^([A-Za-z][A-Za-z _-]{1,30})\s*[:=]\s*(.+)\z"
WIELD_PATTERN = r"(?iU)\bwields?\s+(?:an?\s+)?([A-Za-z][A-Za-z' -]{1,40})"
NAME_HINT_PATTERNS = [
    r"(?iU)\b(?:named|called|name)\b\s+([A-Za-z][A-Za-z' -]{0,60})",
    r"(?iU)\b(?:namens|heisst)\b\s+([A-Za-z][A-Za-z' -]{0,60})",
]
EDGE_PUNCTUATION = " .,:;"
NAME_EDGE_PUNCTUATION = " '\".,;:-"

# --- fixed values: speeches -------------------------------------------------
SPEAKER_PATTERN = r"^([A-Za-z][A-Za-z '\-]{0,40})[.:]?$"
SPEAKER_STOP_WORDS = ["ACT", "SCENE", "EPILOGUE", "PROLOGUE"]
ANSWER_MARK = "[ANSWER]"
END_MARK = "[END]"
TASK_MARKS = {"A": "[SPEAKER]", "B": "[CLASSIFY]"}
MARKERS = ["[SPEAKER]", "[CLASSIFY]", "[ANSWER]", "[END]", "VERSE", "PROSE"]
MARKER_TEXT = "[SPEAKER][CLASSIFY][ANSWER][END]VERSEPROSE"

# --- fixed values: fuzzy cut-offs ------------------------------------------
FUZZY_CUTOFFS = {
    "alignment": 0.84, "emotional_state": 0.84, "race": 0.84,
    "primary_class": 0.82, "subclass": 0.84, "weapon": 0.85,
}
VALUE_CUTOFF = 0.82

# --- fixed values: stories and personas ------------------------------------
STORY_TEMPLATES = [
    "{name} was born into a {background} life among the {race} people. "
    "As a {primary_class}, they spent years honing their craft before leaving home. "
    "{alignment_sentence} Now they wander the land, shaped by both hardship and wonder.",

    "Few knew the early struggles of {name}, a {race} {primary_class} raised in {background_lower} circumstances. "
    "{alignment_sentence} Their journey has taken them far from where they began, "
    "and every scar tells a story.",

    "{name} never expected to become a {primary_class}. "
    "Born of {race} heritage, their {background_lower} background gave them skills others overlooked. "
    "{alignment_sentence} Life on the road has taught them that nothing comes without a cost.",

    "The story of {name} is one of quiet determination. "
    "This {race} {primary_class} emerged from a {background_lower} past with little more than talent and grit. "
    "{alignment_sentence} People who underestimate them rarely make that mistake twice.",
]
STORY_TAIL = (
    " They currently seem {emotional_state} and are focused on {goal}. "
    "A noticeable quirk: {quirk}. One thing they keep hidden is that they {secret}."
)
STORY_TRAITS = " Additional details others notice: {traits}."
STORY_DEFAULTS = {
    "background": "humble", "emotional_state": "curious", "goal": "find direction",
    "quirk": "keeps careful notes", "secret": "is carrying old regret",
}
ALIGNMENT_SENTENCES = {
    "Lawful Good": "They believe in order and justice above all else.",
    "Neutral Good": "They try to do right by the people they meet.",
    "Chaotic Good": "Rules matter less to them than doing what feels right.",
    "Lawful Neutral": "They follow a strict personal code, though not always kindly.",
    "True Neutral": "They keep to themselves and let the world spin as it will.",
    "Chaotic Neutral": "They live by no one's rules — not even their own.",
    "Lawful Evil": "They pursue their goals with cold, calculated precision.",
    "Neutral Evil": "Self-interest guides every decision they make.",
    "Chaotic Evil": "They leave chaos in their wake, and prefer it that way.",
}
PERSONA_TEMPLATE = (
    "You are {name}, a {race} {primary_class} with the subclass or specialty '{subclass}'. "
    "You wield {weapon}. Your alignment is {alignment} and your current emotional state is {emotional_state}. "
    "Your background story: {story} "
    "Your current goal is to {goal}. Your quirk is that you {quirk}. "
    "Extra described traits: {traits}. "
    "Recent world updates affecting you: {recent_notes}. "
    "{tone} {mannerism} "
    "Always respond as {name} in the first person. Stay in character. Keep answers under 3 sentences."
)
PERSONA_DEFAULTS = {
    "subclass": "Wanderer", "alignment": "True Neutral", "emotional_state": "curious",
    "weapon": "an adventurer's weapon", "goal": "stay alive",
    "quirk": "watch people carefully",
}
NO_NOTES = "No recent updates."
NO_TRAITS = "No extra traits."
ALIGNMENT_TONES = {
    "Lawful Good": "You are honorable, direct, and kind. You uphold the law.",
    "Neutral Good": "You are warm, helpful, and genuine.",
    "Chaotic Good": "You are free-spirited, bold, and care deeply about doing right.",
    "Lawful Neutral": "You are formal, disciplined, and impartial.",
    "True Neutral": "You are reserved, observant, and speak carefully.",
    "Chaotic Neutral": "You are unpredictable, witty, and march to your own drum.",
    "Lawful Evil": "You are cold, calculating, and choose your words for maximum effect.",
    "Neutral Evil": "You are self-serving and guarded. Every word is a transaction.",
    "Chaotic Evil": "You are menacing, erratic, and enjoy unsettling others.",
}
TONE_DEFAULT = "You speak plainly."
CLASS_MANNERISMS = {
    "Fighter": "You speak plainly and value action over words.",
    "Wizard": "You tend to use precise, sometimes overly technical language.",
    "Rogue": "You choose your words carefully and rarely reveal more than needed.",
    "Cleric": "You often reference your faith and speak with quiet conviction.",
    "Ranger": "You are brief, observant, and comfortable with silence.",
    "Paladin": "You are earnest and formal, with a strong moral compass.",
    "Barbarian": "You speak bluntly, sometimes too loud, always honest.",
    "Bard": "You are charming, verbose, and love a good story.",
    "Druid": "You speak with reverence for nature and think in long timescales.",
    "Sorcerer": "You are intense and prone to cryptic remarks about fate.",
    "Warlock": "You are guarded, enigmatic, and occasionally ominous.",
    "Monk": "You are calm, measured, and choose every word with intention.",
}
MANNERISM_DEFAULT = "You speak naturally."
COMPLETION_SYSTEM = (
    "Finalize fantasy NPC creation data and return JSON only. "
    "Allowed keys: name, race, primary_class, subclass, background, alignment, emotional_state, "
    "weapon, level, HP, AC, Str, Dex, Con, Int, Wis, Cha, goal, quirk, secret, story, extra_traits. "
    "Treat fixed_values as locked and do not change them. "
    "If you output a name, output only the name itself, never descriptors, titles, or trailing clauses, and keep it to 1 to 3 words. "
    "Correct obvious typos in fantasy terms when the intent is clear. "
    "For goal, quirk, and secret, create fresh phrasing that fits the character and do not reuse stock phrases verbatim. "
    "Keep story to 2 or 3 sentences."
)
COMPLETION_USER = (
    "User prompt:\n{prompt}\n\nfixed_values:\n{locked}\n\n"
    "current_character_draft:\n{draft}\n\n"
    "If a field is already fixed, omit it from your JSON."
)

# --- fixed values: conversation ---------------------------------------------
# (intent, keywords); a turn takes the first intent with a keyword inside it
INTENT_KEYWORDS = [
    ("greeting", ["hello", "hi", "hey", "greetings", "good day", "well met", "howdy"]),
    ("who", ["who are you", "your name", "who", "name", "introduce"]),
    ("quest", ["quest", "job", "task", "work", "mission", "help", "need"]),
    ("fight", ["fight", "battle", "combat", "weapon", "war", "enemy", "attack", "danger"]),
    ("trade", ["buy", "sell", "trade", "gold", "coin", "price", "shop", "merchant"]),
    ("info", ["where", "town", "road", "map", "direction", "know", "tell me", "news"]),
    ("farewell", ["bye", "farewell", "goodbye", "leave", "go now", "see you"]),
    ("threat", ["die", "kill", "threat", "hurt", "blood", "destroy"]),
    ("compliment", ["good", "great", "brave", "strong", "wise", "well done", "impressive"]),
]
INTENT_DEFAULT = "generic"

# (intent, mood group, class group, lines). "*" is the row used when no
# specific row exists; a mood group is evil, chaotic, lawful or plain.
REPLY_LINES = [
    ("greeting", "*", "*", [
        "Well met, stranger. I am {name}.",
        "*nods* {name}. I am feeling {emotional_state} today. And you are?",
        "Greetings. I do not often get visitors. What brings you to me?",
    ]),
    ("greeting", "evil", "*", [
        "...*eyes you carefully*... {name}. State your purpose.",
        "You address me directly. Bold. I am {name}.",
    ]),
    ("greeting", "chaotic", "*", [
        "Ha! A face I have not seen before. {name}'s the name.",
        "*spins around* Oh! Did not hear you coming. {name}, at your service. Maybe.",
    ]),
    ("who", "*", "*", [
        "I am {name}, a {race} {primary_class} from a {background} background. "
        "I have been focused on {goal}, and I am known for someone who {quirk}. "
        "What more do you need to know?",
    ]),
    ("quest", "*", "*", [
        "I do not hand out quests here, but I can tell you what I am dealing with if you insist.",
        "I am focused on {goal}. If you want to help, ask the right questions.",
        "*lowers voice* I have my own concerns, not a task board.",
    ]),
    ("fight", "*", "martial", [
        "Combat? *{name} grips their weapon.* I know exactly what {background_lower} steel feels like in a bad situation.",
    ]),
    ("fight", "*", "arcane", [
        "Brute force is a last resort. I have other ways of dealing with enemies.",
    ]),
    ("fight", "*", "*", [
        "I try to avoid unnecessary conflict. But I am no easy target.",
    ]),
    ("trade", "*", "*", [
        "I am not a merchant. But I may know someone who deals in such things.",
        "Gold has its uses, but I care more about leverage than coin.",
    ]),
    ("trade", "evil", "*", [
        "Everything has a price. What exactly are you offering?",
    ]),
    ("info", "*", "*", [
        "I have traveled these roads. What do you want to know?",
        "The last I heard, things changed faster than people admit.",
        "Information costs nothing, I suppose. Ask your question.",
    ]),
    ("farewell", "*", "*", [
        "Safe travels. Watch the roads.",
        "*nods* Until next time.",
        "Go well. This world has enough graves already.",
    ]),
    ("threat", "evil", "*", [
        "*smiles coldly* Is that a threat? Interesting choice.",
    ]),
    ("threat", "*", "brawler", [
        "*stands up slowly* Say that again. I dare you.",
    ]),
    ("threat", "*", "*", [
        "I would choose your next words carefully.",
    ]),
    ("compliment", "*", "*", [
        "*raises an eyebrow* ...Thank you. I suppose.",
        "Flattery is a dangerous tool, but I appreciate the attempt.",
        "Kind words are rare enough that I remember them.",
    ]),
    ("generic", "*", "*", [
        "*{name} considers your words.* Go on.",
        "Hmm. I am not sure what to make of that.",
        "You are an odd one. I will give you that.",
        "I have heard stranger things. What is your point?",
        "Keep talking. I am listening.",
        "I am still focused on {goal}. If you want my trust, be direct.",
    ]),
]
GENERIC_EXTRA = {
    "chaotic": "*laughs unexpectedly* Sorry, you reminded me of something. What were you saying?",
    "lawful": "Speak plainly. I have little patience for riddles.",
}
REPLY_DEFAULTS = {
    "primary_class": "wanderer", "race": "", "alignment": "True Neutral",
    "background": "humble", "emotional_state": "curious",
    "goal": "keep going", "quirk": "watch everything",
}
MARTIAL_CLASSES = ["Fighter", "Barbarian", "Paladin", "Ranger"]
BRAWLER_CLASSES = ["Barbarian", "Fighter"]
ARCANE_CLASSES = ["Wizard", "Sorcerer", "Warlock"]

SUGGESTIONS = [
    "Tell me about yourself.",
    "How are you feeling right now?",
    "What do you want most at the moment?",
    "What should I know about your {weapon}?",
    "What part of your past still defines you?",
    "What do you think of me so far?",
]
GUARDED_SUGGESTION = "Why are you so guarded?"
GUARDED_MOODS = ["hostile", "suspicious", "cynical"]
NOTES_SUGGESTION = "How did the recent events change you?"

# --- fixed values: experiment grid ------------------------------------------
MODEL_GRID = [  # label, layers, heads, width
    ("XS", 2, 2, 64), ("S", 4, 4, 128), ("M", 6, 6, 384), ("L", 8, 8, 512),
]
FRACTIONS = [("10%", 0.10), ("25%", 0.25), ("50%", 0.50), ("100%", 1.00)]
BATCH_SIZE = 64
BLOCK_SIZE = 256
ACCUMULATION = 1
MAX_ITERS = 2500
PEAK_FLOPS = 312e12
RANDOM_BASELINE = ("Random baseline", 0.10, 0.50)
RUN_CONFIGS = [  # run, category, learning rate, layers, width(heads), block, dropout, iterations
    ("baseline", "Baseline", "1e-3", 6, "384(6)", 256, 0.2, 5000),
    ("lr-1e-4", "Learning Rate", "1e-4", 6, "384(6)", 256, 0.2, 5000),
    ("lr-5e-4", "Learning Rate", "5e-4", 6, "384(6)", 256, 0.2, 5000),
    ("lr-5e-3", "Learning Rate", "5e-3", 6, "384(6)", 256, 0.2, 5000),
    ("lr-1e-2", "Learning Rate", "1e-2", 6, "384(6)", 256, 0.2, 5000),
    ("depth-2", "Depth", "1e-3", 2, "384(6)", 256, 0.2, 5000),
    ("depth-4", "Depth", "1e-3", 4, "384(6)", 256, 0.2, 5000),
    ("depth-8", "Depth", "1e-3", 8, "384(6)", 256, 0.2, 5000),
    ("128-4heads", "Width", "1e-3", 6, "128(4)", 256, 0.2, 5000),
    ("256-4heads", "Width", "1e-3", 6, "256(4)", 256, 0.2, 5000),
    ("block-64", "Context Length", "1e-3", 6, "384(6)", 64, 0.2, 5000),
    ("block-128", "Context Length", "1e-3", 6, "384(6)", 128, 0.2, 5000),
    ("dropout-0-0", "Dropout", "1e-3", 6, "384(6)", 256, 0.0, 5000),
    ("dropout-0-1", "Dropout", "1e-3", 6, "384(6)", 256, 0.1, 5000),
    ("dropout-0-4", "Dropout", "1e-3", 6, "384(6)", 256, 0.4, 5000),
    ("td1000", "Duration", "1e-3", 6, "384(6)", 256, 0.2, 1000),
    ("td2500", "Duration", "1e-3", 6, "384(6)", 256, 0.2, 2500),
    ("td10000", "Duration", "1e-3", 6, "384(6)", 256, 0.2, 10000),
]
