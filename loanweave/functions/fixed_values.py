"""Fixed values. They define the results, so they are stated as they are.

Nothing here is computed: edges, labels, rates and thresholds of the credit rules.
"""

# Columns of a loan.
RAW_NUMERIC = ["duration", "amount", "present_residence", "age", "number_credits", "people_liable"]
CATEGORICAL = [
    "status",
    "credit_history",
    "purpose",
    "savings",
    "employment_duration",
    "personal_status_sex",
    "other_debtors",
    "property",
    "other_installment_plans",
    "housing",
    "job",
    "telephone",
    "foreign_worker",
]
TARGET = "credit_risk"
UNKNOWN = "Unknown"

# Bin labels and the condition each one stands for ({c} is the column).
# The last label has no condition: it takes every value the others leave over.
BINS = {
    "duration": [
        ("<=12", "{c} <= 12"),
        ("13-24", "{c} BETWEEN 13 AND 24"),
        ("25-36", "{c} BETWEEN 25 AND 36"),
        ("37-48", "{c} BETWEEN 37 AND 48"),
        (">48", None),
    ],
    "amount": [
        ("<=1000", "{c} <= 1000"),
        ("1001-2000", "{c} BETWEEN 1001 AND 2000"),
        ("2001-5000", "{c} BETWEEN 2001 AND 5000"),
        ("5001-10000", "{c} BETWEEN 5001 AND 10000"),
        (">10000", None),
    ],
    "present_residence": [
        ("<=1", "{c} <= 1"),
        ("2-3", "{c} BETWEEN 2 AND 3"),
        (">=4", None),
    ],
    "age": [
        ("<25", "{c} < 25"),
        ("25-35", "{c} BETWEEN 25 AND 35"),
        ("36-45", "{c} BETWEEN 36 AND 45"),
        ("46-60", "{c} BETWEEN 46 AND 60"),
        (">60", None),
    ],
    "number_credits": [
        ("0-1", "{c} <= 1"),
        ("2", "{c} = 2"),
        (">=3", None),
    ],
    "people_liable": [
        ("0", "{c} = 0"),
        ("1", "{c} = 1"),
        (">=2", None),
    ],
}

# Probability of default by credit history, and when the loan is bad.
PD_BY_HISTORY = {
    "no credits taken/ all credits paid back duly": "0.03",
    "all credits at this bank paid back duly": "0.05",
    "existing credits paid back duly till now": "0.10",
    "delay in paying off in the past": "0.25",
    "critical account/ other credits existing (not at this bank)": "0.45",
}
PD_OTHER_HISTORY = "0.20"
PD_BAD = "0.60"

# Loss given default by purpose.
LGD_BY_PURPOSE = {
    "car (new)": "0.25",
    "car (used)": "0.30",
    "furniture/equipment": "0.35",
    "retraining": "0.35",
    "radio/television": "0.40",
    "repairs": "0.40",
    "education": "0.30",
    "domestic appliances": "0.45",
    "business": "0.60",
}
LGD_OTHER_PURPOSE = "0.45"

# Profit margin by upper bound of PD.
MARGIN_BY_PD = [("0.05", "0.08"), ("0.10", "0.10"), ("0.25", "0.12"), ("0.45", "0.18")]
MARGIN_ABOVE = "0.25"

# PD category by exclusive upper bound of PD.
CATEGORY_BY_PD = [("0.02", "Très faible"), ("0.05", "Faible"), ("0.10", "Moyen"), ("0.20", "Élevé")]
CATEGORY_ABOVE = "Très élevé"

# Segment by inclusive upper bound of PD, decision texts and cut-offs.
SEGMENT_BY_PD = [("0.03", "A"), ("0.10", "B")]
SEGMENT_ABOVE = "C"
ACCEPT, REFUSE = "ACCEPTE", "REFUSE"
PD_DECISION_CUTOFF = 0.05
PROBABILITY_CUTOFF = 0.5

# Portfolio texts, budget, audit texts.
HIGH_RISK, LOW_RISK = "Risque élevé", "Risque faible"
OPTIMIZED, BASELINE = "Optimized", "Baseline"
RISK_UP, RISK_DOWN = "Augmente le risque", "Diminue le risque"
BUDGET_FRACTION = "0.30"
WATERFALL_STEPS = [("Baseline", 1), ("Removed Credits", 2), ("Exposure Reduction", 3), ("Optimized", 4)]

# Training.
TRAIN_FRACTION, SEED = 0.7, 42
MAX_ITERATIONS = 50

# Name of the optimised table, and its columns that are stored as DOUBLE.
OPTIMISED_TABLE = "credit_scoring_optimised"
AS_DOUBLE = [
    "PD_history",
    "PD",
    "LGD",
    "profit_margin",
    "expected_profit",
    "expected_loss",
    "expected_value",
    "exposure_at_risk",
]
