"""Stop lists used by the tokenizers.

Fixed values: they must equal the lists the original pipeline used for
its results to be reproduced, so they are stated plainly here.
"""

# The common English stop list (179 entries) removed by the
# sentence tokenizer step (T2). Entries with an apostrophe can never match
# text that went through ``clean_text``, which deletes apostrophes; they are
# kept so the list is the published one.
ENGLISH_STOP_WORDS = (
    "i", "me", "my", "myself", "we", "our", "ours", "ourselves", "you", "you're",
    "you've", "you'll", "you'd", "your", "yours", "yourself", "yourselves", "he",
    "him", "his", "himself", "she", "she's", "her", "hers", "herself", "it", "it's",
    "its", "itself", "they", "them", "their", "theirs", "themselves", "what", "which",
    "who", "whom", "this", "that", "that'll", "these", "those", "am", "is", "are",
    "was", "were", "be", "been", "being", "have", "has", "had", "having", "do",
    "does", "did", "doing", "a", "an", "the", "and", "but", "if", "or", "because",
    "as", "until", "while", "of", "at", "by", "for", "with", "about", "against",
    "between", "into", "through", "during", "before", "after", "above", "below",
    "to", "from", "up", "down", "in", "out", "on", "off", "over", "under", "again",
    "further", "then", "once", "here", "there", "when", "where", "why", "how", "all",
    "any", "both", "each", "few", "more", "most", "other", "some", "such", "no",
    "nor", "not", "only", "own", "same", "so", "than", "too", "very", "s", "t",
    "can", "will", "just", "don", "don't", "should", "should've", "now", "d", "ll",
    "m", "o", "re", "ve", "y", "ain", "aren", "aren't", "couldn", "couldn't",
    "didn", "didn't", "doesn", "doesn't", "hadn", "hadn't", "hasn", "hasn't",
    "haven", "haven't", "isn", "isn't", "ma", "mightn", "mightn't", "mustn",
    "mustn't", "needn", "needn't", "shan", "shan't", "shouldn", "shouldn't",
    "wasn", "wasn't", "weren", "weren't", "won", "won't", "wouldn", "wouldn't",
)


def load_stop_list(path: str | None) -> tuple[str, ...]:
    """Read a one-word-per-line stop list; ``None`` gives the T2 list.

    The feature tokenizer (F1) in the original used a second, longer list
    from its vectorizer library. That list is not bundled; pass it as a file
    here to reproduce it exactly.
    """
    if path is None:
        return ENGLISH_STOP_WORDS
    with open(path, encoding="utf-8") as fh:
        return tuple(w.strip() for w in fh if w.strip() and not w.startswith("#"))
