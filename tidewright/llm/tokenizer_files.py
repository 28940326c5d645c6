"""Where the public tokenizer files lie; they are never copied into the repository."""

from __future__ import annotations

import os

FOLDER = "/opt/tokenizers"


def path(name: str, folder: str = FOLDER) -> str:
    return os.path.join(folder, name)
