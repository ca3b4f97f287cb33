"""Panel configuration (D7, D12): what differs between the household and provider panels.

Column names are the ingest names (dots → underscores); question codes keep their
original spelling and are what the long table's ``question`` column holds.
"""

from __future__ import annotations

from dataclasses import dataclass, field, replace

from verbatim.functions.names import dotted_to_snake


@dataclass(frozen=True)
class PanelConfig:
    name: str                          # short panel key used in page names ("ec", "cc")
    id_col: str                        # respondent id
    week_col: str                      # wave ordinal; NULL sorts last
    gate_col: str                      # keep rows whose gate code is 1
    zip_col: str                       # zip as recorded
    language_col: str                  # language code column
    poverty_col: str                   # poverty flag; its name drifts by version
    question_codes: tuple[str, ...]    # ordered; position = question number
    carried: tuple[str, ...]           # demographics carried forward (ingest names)
    demographics: tuple[str, ...]      # demographic columns of the long table, in order
    language_labels: dict = field(default_factory=dict)
    child_count_col: str | None = None                  # household only
    flag_prefix: str | None = None                      # provider only
    provider_rules: tuple = ()                          # (label, flag suffixes), first wins
    tiebreak: str | None = None                         # order inside a week
    languages: tuple[str, ...] | None = None            # optional language filter (F2)

    @property
    def question_columns(self) -> dict[str, str]:
        """ingest column name → question code."""
        return {dotted_to_snake(c): c for c in self.question_codes}


# Language codes and their labels.
LANGUAGE_LABELS = {"EN": "English", "SPA": "Spanish"}

# Household open-ended question codes, in page order (1..68).
EC_QUESTIONS = (
    "OPEN.001", "OPEN.002", "OPEN.003", "OPEN.004", "OPEN.005", "OPEN.007", "OPEN.008",
    "OPEN.009", "OPEN.010", "COVID.007", "COVID.008", "CTAX.008", "CTAX.016", "DEBT.005",
    "DEBT.006", "FamCon.016", "FamCon.017", "FamCon.018", "GRAND.016", "HEALTH.024",
    "HEALTH.030", "JOB.030", "MH.013", "MH.014", "POLICY.030", "PREG.028", "PREG.029",
    "PREG.038", "PREG.040", "PREG.044", "STIM.001.d", "STIM.002.d", "STIM.003.d",
    "STIM.004.d", "STIM.005.d", "WKFORCE.011", "OPEN.011", "POLICY.033", "NEEDS.007",
    "WIC.009", "CTAX.022", "POLICY.036", "FSTR.008", "JOB.040.a", "HEALTH.038", "OPEN.012",
    "OPEN.013", "CTAX.026", "CLIM.002", "CLIM.004", "CLIM.012", "OPEN.014", "OPEN.015",
    "OPEN.016", "Fam.003", "JVQ.004", "JVQ.005", "OPEN.017", "OPEN.018", "OPEN.019",
    "OPEN.020", "TRUST.005", "OPEN.021", "OPEN.022", "OPEN.023", "CLIM.017", "CLIM.019",
    "CLIM.020",
)

# Provider open-ended question codes, in page order (1..39).
CC_QUESTIONS = (
    "CC.OPEN.001", "CC.OPEN.002", "CC.OPEN.003", "CC.OPEN.004", "CC.OPEN.005", "CC.OPEN.006",
    "CC.OPEN.008", "CC.CCS.004", "CC.CCS.005", "CC.CTAX.008", "CC.CTAX.016", "CC.DEBT.005",
    "CC.DEBT.006", "CC.FamCon.016", "CC.FamCon.017", "CC.FamCon.018", "CC.MH.013",
    "CC.SF.010", "CC.Staff.009", "CC.STIM.001.d", "CC.STIM.002.d", "CC.STIM.003.d",
    "CC.STIM.004.d", "CC.STIM.005.d", "CC.WellB.002", "CC.VACC.003", "CC.OPEN.009",
    "CC.OPEN.010", "CC.OPEN.011", "CC.Access.002", "CC.CTAX.029", "CC.FoodAid.002",
    "CC.FoodAid.005", "CC.FoodAid.007", "CC.HEALTH.039", "CC.Inflation.004",
    "CC.ProvDebt.007", "CC.Violence.002", "CC.Fam.003",
)

# Provider type from multi-select flags CC.DEMO.013_k, first match wins.
PROVIDER_RULES = (
    ("Center teacher", (1,)),
    ("Center director", (2,)),
    ("Home-based provider", (3, 4, 8, 12, 9, 13)),
    ("FFN", (5,)),
    ("Babysitter/nanny", (6, 10, 11)),
)

EC = PanelConfig(
    name="ec", id_col="CaregiverID", week_col="Week", gate_col="OPEN_006",
    zip_col="DEMO_001", language_col="UserLanguage", poverty_col="FPL_2019_150",
    question_codes=EC_QUESTIONS,
    carried=("State", "below_1_5x_fpl", "RaceGroup", "CaregiverAge", "child_0_3", "zip",
             "Language"),
    demographics=("State", "below_1_5x_fpl", "zip", "Language", "RaceGroup", "CaregiverAge",
                  "child_0_3"),
    language_labels=LANGUAGE_LABELS, child_count_col="DEMO_004_a_2",
)

CC = PanelConfig(
    name="cc", id_col="ProviderID", week_col="Week", gate_col="CC_OPEN_007",
    zip_col="CC_DEMO_001", language_col="UserLanguage", poverty_col="FPL_2019_150",
    question_codes=CC_QUESTIONS,
    carried=("State", "below_1_5x_fpl", "zip", "RaceGroup", "provider_type", "Language"),
    demographics=("State", "below_1_5x_fpl", "zip", "RaceGroup", "provider_type", "Language"),
    language_labels=LANGUAGE_LABELS, flag_prefix="CC_DEMO_013_",
    provider_rules=PROVIDER_RULES,
)


def codes_from_columns(columns, prefixes=(), explicit=(), exclude=()) -> tuple[str, ...]:
    """Question codes picked from a wave file's (original, dotted) column names.

    Columns starting with any of ``prefixes`` (case-insensitive) in file order, then the
    ``explicit`` codes in the given order, without repeats and without ``exclude`` —
    how the earlier drivers chose their questions.
    """
    low = [p.lower() for p in prefixes]
    picked = [c for c in columns if any(c.lower().startswith(p) for p in low)]
    picked += [c for c in explicit if c not in picked]
    drop = set(exclude)
    return tuple(c for c in picked if c not in drop)


# Explicit (non-prefix) question codes of the first household driver.
FIRST_EC_EXPLICIT = (
    "COVID.007", "COVID.008", "CTAX.008", "DEBT.005", "DEBT.006", "FamCon.016", "FamCon.017",
    "FamCon.018", "HEALTH.024", "HEALTH.030", "JOB.030", "MH.013", "POLICY.030", "PREG.028",
    "PREG.029", "PREG.038", "PREG.040", "STIM.001.d", "STIM.002.d", "STIM.003.d", "STIM.004.d",
    "WKFORCE.011",
)

# Explicit (non-prefix) question codes of the archived household driver.
ARCHIVED_EC_EXPLICIT = (
    "COVID.007", "COVID.008", "CTAX.008", "CTAX.016", "DEBT.005", "DEBT.006", "FamCon.016",
    "FamCon.017", "FamCon.018", "GRAND.016", "HEALTH.024", "HEALTH.030", "JOB.030", "MH.013",
    "MH.014", "POLICY.030", "PREG.028", "PREG.029", "PREG.038", "PREG.040", "PREG.044",
    "STIM.001.d", "STIM.002.d", "STIM.003.d", "STIM.004.d", "STIM.005.d", "WKFORCE.011",
)

# Explicit (non-prefix) question codes of the archived provider driver.
ARCHIVED_CC_EXPLICIT = (
    "CC.CCS.004", "CC.CCS.005", "CC.CTAX.008", "CC.CTAX.016", "CC.DEBT.005", "CC.DEBT.006",
    "CC.FamCon.016", "CC.FamCon.017", "CC.FamCon.018", "CC.MH.013", "CC.SF.010",
    "CC.Staff.009", "CC.STIM.001.d", "CC.STIM.002.d", "CC.STIM.003.d", "CC.STIM.004.d",
    "CC.STIM.005.d", "CC.WellB.002", "CC.VACC.003", "CC.VACC.003.1",
)


def first_household_config(columns) -> PanelConfig:
    """The first driver: one household panel, English only, no Language column."""
    return replace(
        EC, poverty_col="FPL_2019_UM_150", languages=("EN",),
        question_codes=codes_from_columns(columns, ("OPEN",), FIRST_EC_EXPLICIT, ("OPEN.006",)),
        carried=("State", "below_1_5x_fpl", "RaceGroup", "CaregiverAge", "child_0_3", "zip"),
        demographics=("State", "below_1_5x_fpl", "zip", "RaceGroup", "CaregiverAge", "child_0_3"))


def archived_household_config(columns) -> PanelConfig:
    return replace(
        first_household_config(columns), poverty_col="FPL_Curr_150",
        question_codes=codes_from_columns(columns, ("OPEN",), ARCHIVED_EC_EXPLICIT, ("OPEN.006",)))


def archived_provider_config(columns) -> PanelConfig:
    return replace(
        CC, poverty_col="FPL_CURR_150", languages=("EN",),
        question_codes=codes_from_columns(columns, ("CC.OPEN",), ARCHIVED_CC_EXPLICIT,
                                          ("CC.OPEN.007",)),
        carried=("State", "below_1_5x_fpl", "zip", "RaceGroup", "provider_type"),
        demographics=("State", "below_1_5x_fpl", "zip", "RaceGroup", "provider_type"))
