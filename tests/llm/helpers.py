import re

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def word_list(text):
    return WORD.findall(text or "")
