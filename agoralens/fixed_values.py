"""Values that results depend on. They are plain data and are kept in one place."""

# Position names, and how many sample texts a topic shows of each.
POSITIONS = ("claim", "evidence", "counterclaim", "rebuttal")
SAMPLE_LIMITS = {"claim": 3, "evidence": 3, "counterclaim": 2, "rebuttal": 2}
SAMPLE_FIELDS = {
    "claim": "claims",
    "evidence": "evidence",
    "counterclaim": "counterclaims",
    "rebuttal": "rebuttals",
}

# Defaults of the matching, reporting and summary steps.
TOP_K = 5
MATCH_THRESHOLD = 0.5
REPORT_GUIDE = 0.7
SWEEP_STEPS = 21
SWEEP_WIDTH = 0.05
SIMILARITY_BINS = 50
CONFIDENCE_BINS = 30
MIN_TEXT_LENGTH = 10
PREVIEW_LENGTH = 150
SUMMARY_TEXTS = 10
SUMMARY_MAX_WORDS = 150
SUMMARY_MIN_WORDS = 50
SPLIT_SHARE = 0.2
SPLIT_SEED = 42

# Sentences that stand in for a missing sample list or conclusion.
NO_SAMPLES = "No opinions in this category"
NO_DATA = "No sufficient data for conclusion"
ERROR_PREFIX = "Error: "

# The prompt text of one topic. {name} marks a field.
PROMPT = """
            Based on social media analysis of {total} opinions about the following topic:

            TOPIC:
            {topic_text}

            ANALYSIS RESULTS:
            - Claims supporting the topic: {claim_count} opinions ({claim_pct}%)
            - Supporting Evidence: {evidence_count} opinions ({evidence_pct}%)
            - Counter-claims opposing: {counterclaim_count} opinions ({counterclaim_pct}%)
            - Rebuttals/Counter-arguments: {rebuttal_count} opinions ({rebuttal_pct}%)

            SAMPLE OPINIONS:
            Supporting Claims:
            {claims}

            Evidence Provided:
            {evidence}

            Counter-claims:
            {counterclaims}

            Rebuttals:
            {rebuttals}

            Please generate a concise, professional conclusion (2-3 sentences) that:
            1. Summarizes the overall sentiment and distribution of opinions
            2. Highlights the key supporting evidence
            3. Acknowledges opposing viewpoints
            4. Provides insight into the balance of arguments

            CONCLUSION:"""

# The characters that count as white space in a text, as the inside of a
# regular-expression class.
SPACE_CLASS = (
    r"\x09-\x0d\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}"
    r"\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
)
TOKEN_PATTERN = r"\p{L}+"
SENTENCE_PATTERN = r"[^.!?\n]+[.!?]*"
