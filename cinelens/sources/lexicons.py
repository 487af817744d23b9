"""Word tables: library defaults and the small fixtures the registered queries use.

Defaults follow the published lexicon-based sentiment method (Hutto &
Gilbert, ICWSM 2014): its negation words and booster words. The valence
lexicon itself is user-supplied (a DataFrame ``(token, valence)``).

The fixture tables use tokens that occur in the driver's ``documents``
table (its prose is invented), so every rule is exercised on real rows.
They are shared with the DuckDB oracle through ``values_sql``.
"""

from __future__ import annotations

# --- fixed values: negation words of the published method -----------------------
NEGATIONS = [
    "aint", "arent", "cannot", "cant", "couldnt", "darent", "didnt", "doesnt",
    "ain't", "aren't", "can't", "couldn't", "daren't", "didn't", "doesn't",
    "dont", "hadnt", "hasnt", "havent", "isnt", "mightnt", "mustnt", "neither",
    "don't", "hadn't", "hasn't", "haven't", "isn't", "mightn't", "mustn't",
    "neednt", "needn't", "never", "none", "nope", "nor", "not", "nothing", "nowhere",
    "oughtnt", "shant", "shouldnt", "uhuh", "wasnt", "werent",
    "oughtn't", "shan't", "shouldn't", "uh-uh", "wasn't", "weren't",
    "without", "wont", "wouldnt", "won't", "wouldn't", "rarely", "seldom", "despite",
]
# --- fixed values: booster words (+1 increment, -1 decrement) ----------------------
BOOSTERS_UP = [
    "absolutely", "amazingly", "awfully", "completely", "considerable", "considerably",
    "decidedly", "deeply", "effing", "enormous", "enormously", "entirely", "especially",
    "exceptional", "exceptionally", "extreme", "extremely", "fabulously", "flipping",
    "flippin", "frackin", "fracking", "fricking", "frickin", "frigging", "friggin", "fully",
    "fuckin", "fucking", "fuggin", "fugging", "greatly", "hella", "highly", "hugely",
    "incredible", "incredibly", "intensely", "major", "majorly", "more", "most",
    "particularly", "purely", "quite", "really", "remarkably", "so", "substantially",
    "thoroughly", "total", "totally", "tremendous", "tremendously", "uber", "unbelievably",
    "unusually", "utter", "utterly", "very",
]
BOOSTERS_DOWN = [
    "almost", "barely", "hardly", "just enough", "kind of", "kinda", "kindof", "kind-of",
    "less", "little", "marginal", "marginally", "occasional", "occasionally", "partly",
    "scarce", "scarcely", "slight", "slightly", "somewhat", "sort of", "sorta", "sortof",
    "sort-of",
]
# --- fixed values: multi-word idioms of the published method (phrase -> valence) -------
IDIOMS = {"the shit": 3.0, "the bomb": 3.0, "bad ass": 1.5, "badass": 1.5, "bus stop": 0.0,
          "yeah right": -2.0, "kiss of death": -1.5, "to die for": 3.0, "beating heart": 3.1,
          "broken heart": -2.9}
# --- fixed values: rule constants of the published method --------------------------
B_INCR = 0.293        # booster increment
C_INCR = 0.733        # all-caps increment
N_SCALAR = -0.74      # negation multiplier
ALPHA = 15.0          # compound normaliser
# -----------------------------------------------------------------------------------

# --- fixed values: Spark's English stop words, what ``operators.keywords.stopwords`` gives by default ---
ENGLISH_STOPWORDS = """
i me my myself we our ours ourselves you your yours yourself yourselves he him his himself she her hers herself it
its itself they them their theirs themselves what which who whom this that these those am is are was were be been
being have has had having do does did doing a an the and but if or because as until while of at by for with about
against between into through during before after above below to from up down in out on off over under again further
then once here there when where why how all any both each few more most other some such no nor not only own same so
than too very s t can will just don should now i'll you'll he'll she'll we'll they'll i'd you'd he'd she'd we'd
they'd i'm you're he's she's it's we're they're i've we've you've they've isn't aren't wasn't weren't haven't hasn't
hadn't don't doesn't didn't won't wouldn't shan't shouldn't mustn't can't couldn't cannot could here's how's let's
ought that's there's what's when's where's who's why's would
""".split()
# -----------------------------------------------------------------------------------

# ---- fixtures (tokens from the driver's invented prose) ----------------------------
FIXTURE_STOPWORDS = ["the", "and", "that", "for", "was", "with", "this", "are", "from",
                     "der", "die", "und", "que", "des", "les"]
FIXTURE_LEMMAS = {"thes": "the", "thea": "the", "thed": "the", "das": "der", "las": "los",
                  "thly": "thle", "erer": "erin", "ther": "then", "thhe": "thha", "thnt": "thin"}
FIXTURE_SENSES = [
    ("rewh", 1, "a first fixture sense", "n", ["one", "two", "three"]),
    ("rewh", 2, "a second fixture sense", "v", ["four"]),
    ("orre", 1, "a sense without examples", "a", []),
    ("thatin", 2, "only a second-rank sense", "r", ["five", "six"]),
]
FIXTURE_LEXICON = {"rewh": 2.0, "orre": 1.5, "thatin": -1.8, "ononst": -2.1, "hehely": 1.2,
                   "ble": -0.9, "best": 3.2, "tion": 0.7, "ing": -0.4, "than": 0.0}
FIXTURE_BOOSTERS = {"the": B_INCR, "of": B_INCR, "and": -B_INCR, "ther": B_INCR, "storth the": -B_INCR}
FIXTURE_IDIOMS = {"the ble": 2.2, "and ble": -1.4, "ing the": 1.1, "are the ble": -2.4, "it the": 0.9}
FIXTURE_NEGATIONS = ["no", "inoran", "orantion"]
FIXTURE_CONTRAST = "than"
# ------------------------------------------------------------------------------------


def booster_table_default() -> dict[str, float]:
    """The published booster words with their signed increments."""
    out = {w: B_INCR for w in BOOSTERS_UP}
    out.update({w: -B_INCR for w in BOOSTERS_DOWN})
    return out


def _lit(v) -> str:
    if v is None:
        return "NULL"
    if isinstance(v, str):
        return "'" + v.replace("'", "''") + "'"
    if isinstance(v, bool):
        return "TRUE" if v else "FALSE"
    if isinstance(v, (list, tuple)):
        return "[" + ", ".join(_lit(x) for x in v) + "]::VARCHAR[]"
    return repr(float(v)) if isinstance(v, float) else str(v)


def values_sql(rows, columns: list[str]) -> str:
    """``(VALUES ...) AS t(columns)`` for a list of tuples (or a list of words)."""
    rows = [r if isinstance(r, tuple) else (r,) for r in rows]
    body = ", ".join("(" + ", ".join(_lit(v) for v in r) + ")" for r in rows)
    return f"(VALUES {body}) AS t({', '.join(columns)})"
