"""A small catalogue for the expansion queries: slots, fallbacks and gaps on purpose."""

LANGUAGES = ["en", "de"]

DEMO = {
    "classes": {
        "simple": {
            "templates": {
                "en": {
                    "imperative": ["name the capital of {place}", "spell {word}", "convert {n} miles"],
                    "casual": ["hey what time is it in {place}?", "quick one, {word} or {unknown}?"],
                    "fragment": ["{word}", "weather {place}"],
                    "implicit": ["never sure about {word}"],
                },
                "de": {
                    "imperative": ["nenne die Hauptstadt von {place}", "buchstabiere {word}"],
                    "fragment": ["Uhrzeit {place}"],
                    "note": "not a list",
                },
                "mixed": {"imperative": ["sag mir the time in {place}", "was heißt {word} in english"]},
            },
            "slot_lists": {"place": ["Rome", "Oslo", "Kyoto"], "word": ["variable", "rhythm"], "n": ["3", "10"], "empty": []},
            "situation_corpus": {
                "en": ["someone on a train checks a fact before the connection drops and the next stop is announced over the speaker again"],
                "de": ["jemand  fragt kurz nach", "in der Pause vor dem Termin"],
            },
            "conversational_wrappers": {"en": ["by the way, [INTENT]", "one more thing"], "de": ["übrigens, [INTENT]"]},
            "cross_class_discriminators": {"vs_reasoning": {"key_signals": ["name the", "no analysis"]}},
            "length_profile": {"short_pct": 0.7},
        },
        "reasoning": {
            "templates": {
                "en": {
                    "imperative": ["compare {a} with {a}", "explain the error in this function."],
                    "implicit": ["the database request takes {n} seconds", "odd result, again"],
                },
                "de": {"imperative": ["vergleiche {a} mit {a}"], "implicit": ["die Abfrage dauert {n} Sekunden"]},
            },
            "slot_lists": {"a": ["sorting", "hashing", "a join"], "n": ["7", "40", "90"]},
            "situation_corpus": {"en": ["a reviewer is not convinced", "two designs are on the table"]},
            "conversational_wrappers": {},
            "cross_class_discriminators": {"vs_agentic": {"key_signals": ["explain", "why"]}},
            "length_profile": {},
        },
        "agentic": {
            "templates": {
                "en": {"imperative": ["migrate the database and run the tests", "find the bug, fix it and open a request"]},
                "de": {"fragment": ["alles umbauen", "Tests, dann ausliefern"]},
                "mixed": {"imperative": []},
            },
            "slot_lists": {},
            "situation_corpus": {"en": ["the release is tomorrow"], "de": ["der Termin ist morgen"]},
            "conversational_wrappers": {"en": ["when you can: [INTENT], and [INTENT] only"]},
            "cross_class_discriminators": {},
            "length_profile": {},
        },
    },
    "compound_bridges": {"en": ["[INTENT_A], then [INTENT_B]", "and after that", "[INTENT_B] but first [INTENT_A]"], "mixed": ["[INTENT_A] und [INTENT_B]"]},
    "noise_patterns": {
        "abbreviations": {"capital": ["cap"], "compare": ["cmp"], "error": ["err", "bug"], "tests": ["specs"], "the": ["th"]},
        "filler_words": {"en": ["um", "you know", "so"], "de": ["also", "halt"]},
    },
}
