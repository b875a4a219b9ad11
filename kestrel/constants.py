"""Values that must equal the original analyses for the results to match.

Everything here is a fixed value, stated as-is and in its natural order.
"""

# --- fixed values: term / category list (position = category index and tie order) ---
DEFAULT_TERMS = [
    "JavaScript", "Java", "PHP", "Python", "C#", "C++", "Ruby", "CSS",
    "Objective-C", "Perl", "Scala", "Haskell", "MATLAB", "Clojure", "Groovy",
]

# --- fixed values: article line layout ---
# A raw article line is  <prefix><title></title><text><text><suffix>.
# The prefix and suffix are only counted, never matched.
TITLE_TEXT_SEPARATOR = "</title><text>"
LINE_PREFIX_LENGTH = 14
LINE_SUFFIX_LENGTH = 16

# --- fixed values: clustering defaults ---
DEFAULT_SPREAD = 50000          # distance between two neighbouring categories on x
DEFAULT_K = 45                  # number of centres
DEFAULT_ETA = 20.0              # convergence bound on the SUM OF SQUARED centre moves
DEFAULT_MAX_ITER = 120          # iteration cap
STRATIFIED_MIN_SPREAD = 500     # spread >= this: per-category sample; below: global sample
SAMPLE_SEED = 42

# --- fixed values: posting types ---
QUESTION_TYPE = 1
ANSWER_TYPE = 2

# --- fixed values: cluster report layout ---
REPORT_HEADER = [
    "Resulting clusters:",
    "  Score  Dominant language (%percent)  Questions",
    "================================================",
]
REPORT_ROW_FORMAT = "%7d  %-17s (%-5.1f%%)      %7d"
