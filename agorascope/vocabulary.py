"""Fixed vocabularies of the analysis schema. Slugs, labels, words and patterns."""

TOPICS = (
    ("ethics-disclosure", "Ethics: disclosure & honesty"),
    ("ethics-training-data", "Ethics: training data & consent"),
    ("ethics-livelihood", "Ethics: jobs & livelihood"),
    ("craft-authenticity", "Craft: authenticity & voice"),
    ("craft-skill-atrophy", "Craft: skill atrophy fears"),
    ("detection-accusations", "AI detection & false accusations"),
    ("community-norms", "Community norms & backlash"),
    ("publishing-industry", "Publishing & platform policy"),
    ("plagiarism-ownership", "Plagiarism, ownership & copyright"),
    ("ai-boundaries", "Where to draw the AI line"),
    ("tools-workflow", "Tools & workflow"),
    ("brainstorm-worldbuilding", "Brainstorming & worldbuilding"),
    ("editing-revision", "Editing & revision"),
    ("continuity-consistency", "Continuity & consistency"),
    ("motivation-blockage", "Motivation, block & accountability"),
    ("provenance-proof", "Proving human authorship"),
    ("nanowrimo-community", "NaNoWriMo / November challenges"),
    ("other", "Other"),
)
STANCES = ("hostile", "wary", "conflicted", "curious", "pragmatic", "enthusiastic", "na")
NEGATIVE = ("hostile", "wary")
EXPERIENCE = ("professional", "hobbyist", "aspiring", "student", "unknown")
STANCE_BASIS = (
    "philosophical-authorship", "economic-livelihood", "craft-quality", "consent-training-data", "community-pressure", "bad-experience", "vague-doom",
)
DEALBREAKER_KINDS = ("missing-feature", "trust-privacy", "ai-policy", "cost", "platform-lock-in", "other")
TOOL_SENTIMENTS = ("positive", "negative", "mixed", "neutral")
SCHEMA_VERSION = 3

#: Patterns of the four product pillars; case does not matter.
PILLARS = {
    "provenance": r"prov(e|enance|able)|proof|receipt|wrote it (myself|themselves)|human.?(written|authored)|disclosure|attest",
    "continuity": r"continuit|consisten|plot hole|timeline|character (detail|bible)|world.?bible|keep track",
    "trustLocal": r"local.?(only|first)|offline|own(s|ing)? my (data|words|manuscript)|not train|no training|privacy",
    "safeAI": r"safe(ly)? (try|experiment|use)|without (the )?guilt|boundar|dial|control (over|of) (the )?ai",
}
#: What counts as mentioning AI, between characters that are not word characters. The boundaries are added by the users of
#: this pattern, as the two regular expression engines that run it take ``\b`` to mean different things beyond ASCII.
AI_WORDS = r"a\.?i\.?|artificial intelligence|chatgpt|gpt-?\d*|claude|gemini|llm|copilot|sudowrite|novelcrafter|midjourney|generative|genai|machine.?(written|generated)|ai-?(generated|written|assisted|slop|art)|prompt(ing|ed)?|algorithm(ic)?ally generated"
ENGLISH_STOPWORDS = (
    "the", "and", "is", "to", "of", "a", "in", "that", "it", "for", "on", "with", "as", "was", "but", "are", "this", "have", "be", "i",
)
REMOVED_MARKERS = ("[removed]", "[deleted]")
BOT_AUTHORS = ("automoderator",)
CRITIQUE_FLAIRS = ("critique", "excerpt", "feedback", "sharing")
FICTION_HEAVY = ("destructivereaders", "betareaders", "writing", "fictionwriting")
DISCOVERY_NOISE = ("all", "askreddit", "popular", "funny", "pics", "memes", "aita", "amitheasshole")
#: Topic slugs of the product's concern, with their points and labels.
RESONANCE_TOPICS = (
    ("provenance-proof", 3, "provenance topic"), ("continuity-consistency", 2, "continuity topic"), ("detection-accusations", 2, "accusation pain"),
    ("ai-boundaries", 1, "boundaries topic"),
)
