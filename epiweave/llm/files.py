"""Binary files in the shared folder: written under a temporary name, then moved to their final one."""

from __future__ import annotations

import re
import uuid
from contextlib import contextmanager

from pyarrow import fs as pafs


def place(uri: str) -> tuple[pafs.FileSystem, str]:
    """File system and path of a folder or file named by a URI or an absolute path."""
    return pafs.FileSystem.from_uri(re.sub(r"^file:/+", "file:///", uri))


@contextmanager
def written(uri: str):
    """Output stream that becomes the file ``uri`` when it ends well. A task that is run again
    after a loss writes the same bytes under another temporary name and moves them to the same place."""
    system, path = place(uri)
    system.create_dir(path.rsplit("/", 1)[0], recursive=True)
    temporary = f"{path}.{uuid.uuid4().hex}.tmp"
    with system.open_output_stream(temporary, compression=None) as out:
        yield out
    system.move(temporary, path)
