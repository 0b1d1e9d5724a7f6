"""The dictionary that primes the compressor of the secret scan, built from public sources by rule.

Words come from a tokenizer's vocabulary (a file of lines ``base64 rank``, its path is a parameter): its
entries of letters alone, in many languages. Parts of identifiers come from the sources of Python's own
standard library, counted by the modules that use them. It is built once, on the driver, and sent to
the executors; its size is bounded by ``MOST_PARTS`` and the vocabulary.
"""

from __future__ import annotations

import base64
import os
import re
import sysconfig
from collections import Counter
from functools import cache

#: Lengths of the words that are taken over.
LEAST, MOST = 5, 20
MOST_PARTS = 8000
_IDENTIFIER = re.compile(r"[A-Za-z_]{4,}")
_PART = re.compile(r"[A-Z]?[a-z]{3,}|[A-Z]{4,}")

#: What surrounds keys in configuration and source files.
CODE = (
    "import from return class public static final void string const function export default async await "
    "def self none true false null undefined config settings environment variable value default example "
    "sample test placeholder changeme your_api_key your_secret_key your_token_here replace_me xxxxxxxxxxxxxxxx "
    "api_key apikey access_key access_token refresh_token auth_token bearer_token client_id client_secret "
    "secret_key private_key public_key password passwd username user_name credentials authorization header "
    "content_type application json localhost http https www com org net path file name host port database "
    "connection_string server endpoint region bucket account service production development staging version "
    "get_password set_password password_hash token_type token_expires_in secret_manager key_vault get_secret "
    "process.env os.environ getenv config.get settings.get request.headers session.token "
    "abcdefghijklmnopqrstuvwxyz ABCDEFGHIJKLMNOPQRSTUVWXYZ 0123456789 0123456789abcdef 12345678901234567890 "
    "-----BEGIN PRIVATE KEY----- -----END PRIVATE KEY----- ssh-rsa begin certificate documentation description "
)


def vocabulary_words(path: str) -> list[str]:
    """Words of a vocabulary file, the most common first."""
    ranked = []
    with open(path, "rb") as f:
        for line in f:
            token, rank = line.split()
            ranked.append((int(rank), base64.b64decode(token)))
    found: dict[str, None] = {}
    for _, token in sorted(ranked):
        try:
            word = token.decode("utf-8").strip()
        except UnicodeDecodeError:
            continue
        if word.isalpha() and LEAST <= len(word) <= MOST:
            found.setdefault(word)
    return list(found)


def identifier_parts(folder: str | None = None, most: int = MOST_PARTS) -> list[str]:
    """Parts of the identifiers in a folder's Python sources, those of the most modules first."""
    folder = folder or sysconfig.get_paths()["stdlib"]
    modules: Counter[str] = Counter()
    for name in sorted(os.listdir(folder)):
        if name.endswith(".py"):
            with open(os.path.join(folder, name), encoding="utf-8", errors="replace") as f:
                modules.update({p for w in set(_IDENTIFIER.findall(f.read())) for p in _PART.findall(w)})
    return [p for p, _ in sorted(modules.items(), key=lambda x: (-x[1], x[0]))[:most]]


@cache
def dictionary(vocabulary: str | None = None) -> bytes:
    """The priming bytes; the most common parts come last, where references to them are shortest."""
    words = vocabulary_words(vocabulary) if vocabulary else []
    return " ".join([*reversed(words), *reversed(identifier_parts()), CODE]).encode("utf-8")
