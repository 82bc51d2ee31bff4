"""Results must agree on these, so they are stated as they are."""

# Extraction flags and their meaning.
FLAGS = {
    "q16_first_principles": "Core belief (first principles)",
    "q17_worldview": "Worldview belief",
    "q18_moral_framework": "Moral/ethical framework",
    "q19_epistemology": "How knowledge is acquired",
    "q20_ontology": "Nature of reality",
    "q21_reasoning_pattern": "Reasoning/logic pattern",
    "q22_assumption": "Underlying assumption",
    "q23_surface_opinion": "Surface-level opinion",
    "q24_factual_claim": "Factual claim",
    "q25_prediction": "Future prediction",
    "q26_value_judgment": "Value judgment",
}

# Tier of each flag, tiers from the top down.
TIERS = {
    "core": ["q16_first_principles", "q20_ontology"],
    "worldview": ["q17_worldview", "q18_moral_framework", "q19_epistemology"],
    "reasoning": ["q21_reasoning_pattern", "q22_assumption"],
    "surface": ["q23_surface_opinion", "q24_factual_claim", "q25_prediction", "q26_value_judgment"],
}

# Snapshot phases in running order.
PHASES = ["utterances", "beliefs_raw", "canonical_beliefs", "clusters_updated"]

# Points taken off an episode's score per event.
PENALTIES = {"errors": 2.0, "retries": 0.5, "malformed": 1.0, "mismatches": 0.5}

# Lowest score of each grade; below the last one is F.
GRADES = {"A": 90, "B": 80, "C": 70, "D": 60}

# Formats of ids, times and audio links.
EPISODE_ID = r"^[a-zA-Z0-9_-]+$"
CLOCK = r"^\d{2}:\d{2}:\d{2}$"
AUDIO_TIME = r"^\d+$|^\d+,\d+$"
AUDIO_MARK = "#t="

# Drift kinds, contradiction kinds.
DRIFT_KINDS = ["new", "dropped", "strengthening", "weakening", "reversal"]
CONTRADICTION_KINDS = ["within_speaker", "cross_speaker"]
