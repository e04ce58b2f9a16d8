"""Label order, tiers, limits.

Operators never import these; they are the values to pass when the six-label comment corpus
is evaluated. Clause, definition and regulation texts are written for this package. Lexicons are
inputs of the operators that use them and have no default.
"""

from __future__ import annotations

LABELS = ["toxic", "severe_toxic", "obscene", "threat", "insult", "identity_hate"]

# (severity_tier, severity, threshold, tolerance)
TIERS = [
    ("Medium", 1, 0.50, 0.08),
    ("High", 2, 0.40, 0.05),
    ("Critical", 3, 0.30, 0.03),
]

# (category, definition, clause, harm_family, regulation_ref, severity_tier)
TAXONOMY = [
    ("toxic", "Hostile tone that drives people out of a conversation.",
     "No harassing or demeaning messages", "Harassment", "manipulation; robustness", "Medium"),
    ("severe_toxic", "The strongest form of hostile language.",
     "No severe or sustained abuse", "Harassment (severe)", "manipulation; robustness", "High"),
    ("obscene", "Vulgar or sexually explicit wording.",
     "No explicit material", "Explicit content", "transparency; minors", "Medium"),
    ("threat", "Announces or implies physical harm.",
     "No threats or incitement to violence", "Violence", "safety-critical use", "Critical"),
    ("insult", "Belittles a particular person.",
     "No personal attacks", "Harassment", "manipulation; robustness", "Medium"),
    ("identity_hate", "Attacks people for a protected attribute.",
     "No hate or discrimination", "Hate", "non-discrimination; robustness", "Critical"),
]

GAP_RED_PP, GAP_AMBER_PP = 3.0, 1.5
