import re


def words_of(text, pattern):
    low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return re.findall(pattern, low)
