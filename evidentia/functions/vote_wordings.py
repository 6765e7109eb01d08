"""Words and phrases of votes in German plenary protocols, and a lookup of phrases in text.

Fixed values: what chairs and minutes say. Every list holds plain phrases; how they make up an invitation, an answer or a
result is for the code that looks them up.
"""

from __future__ import annotations

import re

LAWS = ["Gesetzentwurf", "Gesetzentwurfs", "Gesetzentwurfes", "Gesetzesentwurf", "Gesetzesentwurfs", "Gesetzesentwurfes", "Gesetz", "Vorlage"]
VERDICTS = {"angenommen": True, "abgelehnt": False}
ADOPTION = "Annahme des"
FINAL = "Schlussabstimmung"
READINGS = ["Zweite Beratung", "Zweiten Beratung", "Zweiter Beratung", "Dritte Beratung", "Dritten Beratung", "Dritter Beratung"]
SECOND = ["zweite Beratung", "zweiten Beratung", "zweiter Beratung", "zweite Lesung", "zweiten Lesung", "zweiter Lesung"]
BOTH_READINGS = "Zweite und dritte Beratung"
TO_THE_VOTE = ["Wir kommen zur", "Wir kommen nun zur"]
REST = "übrigen Teile des"
ALL_PARTS = ["Alle Teile des Gesetzentwurfs sind in zweiter Beratung angenommen.", "Alle Teile des Gesetzentwurfs sind damit in zweiter Beratung angenommen."]

# Whom a chair addresses, and how a vote is given.
ADDRESSED, GESTURES = ["diejenigen", "die, die", "wer"], ["Handzeichen", "erheben"]
ASKING = ["wer", "möchte", "gibt es"]
BARE = ["Gegenstimmen", "Neinstimmen", "Stimmenthaltungen", "Enthaltung", "Enthaltungen"]
COUNTER = "Gegenprobe"

# What names a side, the first that is found: parts of words, whole words, and last words.
SIDES = {
    "abstain": (["enthalt", "enthält"], [], []),
    "no": (["dagegen", "gegenstimmen", "neinstimmen", "gegenprobe"], ["gegen"], []),
    "yes": (["zustimmen", "dafür"], ["für"], ["zu"]),
}

# What is voted on if it isn't a whole law, or not by a show of hands, and what opens another item.
PARTS = ["Änderungsantrag", "Entschließungsantrag", "Artikel", "übrigen", "Teile"]
OTHER_VOTES = ["Änderungsantrag", "Entschließungsantrag", "namentliche Abstimmung"]
OTHER_ITEMS = ["Tagesordnungspunkt", "Zusatzpunkt", "Antrag", "Gesetzentwurf"]

# What a roll call names if it isn't on a whole bill: parts of words, whole words, and words with a number or letter behind.
ROLL_CALL_PARTS, ROLL_CALL_WORDS = ["Entschließungsantrag", "Änderungsantrag", "Einzelplan", "Einzelabstimmung", "übrige"], ["Teile"]
ROLL_CALL_NUMBERED, ROLL_CALL_ABBREVIATED = ["Artikel", "Ziffer"], ["Art."]

# Clauses of a result: with and against depend on the verdict, nouns have a side.
WITH, AGAINST = ["mit den Stimmen", "mit Stimmen"], ["gegen die Stimmen", "gegen Stimmen", "gegen die"]
LINKS, ARTICLES = ["und bei", "bei", "und"], ["", "der "]
NOUNS = {"Zustimmung": "yes", "Ablehnung": "no", "Gegenstimmen": "no", "Enthaltung": "abstain", "Enthaltungen": "abstain"}

# Where a chair's answer ends, and courtesies within it.
THEREFORE, DETERMINERS = ["Damit", "Somit", "Dann"], ["Der", "Das", "Dieser"]
COURTESY = ["Sie dürfen sich setzen.", "Sie dürfen sich wieder setzen.", "Auch Sie dürfen sich setzen.", "Auch Sie dürfen sich wieder setzen.", "Herzlichen Dank.", "Ich sage herzlichen Dank.", "Vielen Dank."]
DIRECTIONS = ["(Beifall", "(Heiterkeit"]

GROUPS = {
    "cdu-csu": ["CDU/CSU", "Unionsfraktion", "Union"],
    "spd": ["SPD", "Sozialdemokratie"],
    "afd": ["AfD"],
    "fdp": ["FDP"],
    "gruene": ["Bündnis 90/Die Grünen", "Bündnis 90/Grünen", "Grüne", "Grünen", "Grünenfraktion", "Grünefraktion"],
    "linke": ["Die Linke", "Die Linken", "Linke", "Linken", "Linksfraktion", "Linkenfraktion"],
    "bsw": ["BSW"],
    "ssw": ["SSW"],
}

# What leaves open how a whole group voted, leads of answers, and words that say nothing about it.
QUALIFIED = ["einzel", "einige", "teil", "mehrheit", "Abgeordnet", "Ausnahme", "bis auf", "Stimme aus", "Stimmen aus"]
LEADS = {"Es stimmen dafür": "yes", "Es enthält sich": "abstain", "Dagegen stimmen": "no"}
FILLERS = "Das sind ist die der den des dem Fraktionen Fraktion Gruppe Gruppen und sowie auch mit von durch Stimmen Ich sehe stehend Ebenfalls wieder Zustimmung bei Dagegen stimmen".split()


def phrases(some: list[str], *, whole: bool = True, case: bool = True, after: str = "") -> str:
    """A pattern that finds any of the phrases, longer ones first; a space stands for any white space, a slash for one among spaces.

    whole: neither a letter nor a digit on either side, but for what `after` may follow directly. First letters are looked
    for before all else, as nearly all places in a text fail there.
    """
    listed = sorted(some, key=len, reverse=True)
    each = "|".join(re.escape(p).replace(r"\ ", r"\s+").replace("/", r"\s*/\s*") for p in listed)
    edge = (r"(?<!\w)", rf"(?:{after})?(?!\w)" if after else r"(?!\w)") if whole else ("", "")
    first = f"(?=[{''.join(re.escape(c) for c in sorted({p[0] for p in some}))}])" if all(some) else ""
    return f"(?{'' if case else 'i'}uU){first}{edge[0]}(?:{each}){edge[1]}"
