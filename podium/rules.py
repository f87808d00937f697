"""Season rules as data.

Fixed values that must equal the scoring rules of the series being reproduced are
kept together here, in natural order, as plain text.
"""

from __future__ import annotations

from dataclasses import dataclass, field

# ---------------------------------------------------------------------------
# Fixed values (series scoring rules)
# ---------------------------------------------------------------------------
FLOOR_POINTS = 20.0            # placement points never drop below this
CAP_POINTS = 100.0             # event points never exceed this
PARTICIPATION_POINTS = 20.0    # flat credit for a participation race
AGE_THRESHOLD = 45             # age bonus starts above this age
AGE_RATE = 1.0                 # bonus points per year above the threshold
BEST_K = 6                     # events that count toward the season total
INCENTIVE_STEPS = ((3, 15.0), (6, 20.0), (9, 25.0))  # (events entered, extra points), cumulative
TEAM_K = 3                     # scorers per team, event and division
PODIUM_SIZE = 3                # overall places left out of the age-group awards
REPORT_SENTINEL = 999          # place and age shown for participation rows in CSV reports
STATUS_CODES = ("DNS", "DNF", "*")  # place texts that mark a non-finisher
NOT_A_NAME = ("na", "n/a")          # registration cells that mean "no member"

# Age bands of the age-group awards: (lower, upper), both inclusive.
AGE_BANDS = (
    (0, 30), (31, 35), (36, 40), (41, 45), (46, 50),
    (51, 55), (56, 60), (61, 65), (66, 70), (71, 123),
)

# Open age classes, tested as substrings in this order (order matters: "16-" also
# occurs in a closed class such as "M16-18").
OPEN_AGE_CLASSES = (("70+", 70), ("75+", 75), ("12-", 12), ("19-", 19), ("16-", 16))

# Age-class grammars (regular expressions, matched at the start of the label).
DASH_CLASS = r"^([MF])([0-9]{1,3})-([0-9]{1,3})"               # "M50-54 (3)"
WORDS_CLASS = r"^([MF]) ?([0-9]{1,3}) to ([0-9]{1,3}) \(.+\)"  # "M 50 to 54 (2)"
GENDER_ONLY_CLASS = r"^(Male|Female) \(.+\)"                   # "Male (3)": age unknown
BRACKET_ANYWHERE = r"^.* ([0-9]+) to ([0-9]+) .*"               # "Long race M 50 to 54 (2)": any text around
OPEN_WORDS_CLASS = r"^([MF]) +([0-9]{2})"                      # "M  70 ...": lower bound

# Given names followed by an upper-case surname, e.g. "Anna Maria SMITH-JONES".
CAPS_SURNAME_PATTERN = r"^(([A-Z][a-z]+( |-))+)([A-Z \-']+)$"
# The wording of other sources, with the groups of the given names and the surname.
CAPS_SURNAME_VARIANTS = {
    "initial": (r"^((([A-Z] )?[A-Z][a-z]+( |-))+)([A-Z \-']+)$", (1, 5)),  # "J Anna SMITH"
    "open_end": (r"^(([A-Z][a-z]+( |-))+)([A-Z -]+)", (1, 4)),  # "Anna SMITH (2)"
    "hyphen": (r"^(([A-Z][a-z-]+ )+)([A-Z -]+)", (1, 3)),  # "Anna-maria SMITH"
}
# Placeholder printed for an unnamed entrant, and the name it stands for.
PLACEHOLDER_NAME = "NEED NAME"
PLACEHOLDER_SPLIT = ("Need", "Name")

# Team registration sheet: header of the team name, the captain's pair of columns, and
# the wording of the other member columns ("2nd team member name", ... "10th ...").
TEAM_NAME_HEADER = "Team Name:"
CAPTAIN_HEADERS = ("Team captain/representative name:", "Team captain gender")
MEMBER_HEADER = "{ordinal} team member {field}"
FORM_SLOTS = 10

# Earlier seasons used a gentler age bonus.
LEGACY_AGE_THRESHOLD = 40
LEGACY_AGE_RATE = 0.5


@dataclass(frozen=True)
class ScoringRules:
    floor: float = FLOOR_POINTS
    cap: float = CAP_POINTS
    participation: float = PARTICIPATION_POINTS
    age_threshold: int = AGE_THRESHOLD
    age_rate: float = AGE_RATE
    best_k: int = BEST_K
    steps: tuple = field(default=INCENTIVE_STEPS)
    team_k: int = TEAM_K
    # decimals kept on event points so sums are exact (integer micro-points)
    precision: int = 6


CURRENT = ScoringRules()
LEGACY = ScoringRules(age_threshold=LEGACY_AGE_THRESHOLD, age_rate=LEGACY_AGE_RATE)
