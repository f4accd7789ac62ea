"""Hand-written feed files for tests."""

import gzip
import io
import json
import zipfile
from pathlib import Path

from newsflow import schemas


def feed_line(schema, **values):
    return "\t".join(str(values.get(f.name, "")) for f in schema)


def event_line(event_id, url, **values):
    return feed_line(schemas.EVENTS, GLOBALEVENTID=event_id, SOURCEURL=url, **values)


def entity_line(record_id, url, **values):
    return feed_line(schemas.ENTITIES, GKGRECORDID=record_id, DocumentIdentifier=url, **values)


def write(path, text, encoding="utf-8"):
    path = Path(path)
    path.parent.mkdir(parents=True, exist_ok=True)
    data = text.encode(encoding) if isinstance(text, str) else text
    path.write_bytes(gzip.compress(data) if path.suffix == ".gz" else data)
    return str(path)


def write_zip(path, members, encoding="utf-8"):
    buffer = io.BytesIO()
    with zipfile.ZipFile(buffer, "w", zipfile.ZIP_DEFLATED) as archive:
        for name, lines in members.items():
            archive.writestr(name, ("\n".join(lines) + "\n").encode(encoding))
    return write(path, buffer.getvalue())


def write_json(path, data):
    return write(path, json.dumps(data, indent=4))
