"""A database driver over a JSON file of rows: understands the statements that ranges are read with, and logs them."""

import datetime as dt
import json
import re
import uuid

paramstyle = "numeric"


class Cursor:
    def __init__(self, folder):
        self.folder = folder

    def execute(self, sql, values):
        with open(f"{self.folder}/log/{uuid.uuid4().hex}", "w") as f:
            json.dump([sql, [str(v) for v in values]], f)
        names = re.findall(r'"(\w+)"', sql.split(" FROM ")[0])
        where = sql.split(" WHERE ")[1] if " WHERE " in sql else "True"
        where = re.sub(r'"(\w+)" IS NULL', r"(r['\1'] is None)", where)
        where = re.sub(r'"(\w+)" IN \(([^)]*)\)', r"(r['\1'] in (\2,))", where)
        where = re.sub(r'"(\w+)" (>=|<=|=|<|>) (:\d+)', lambda m: f"(r['{m[1]}'] is not None and r['{m[1]}'] {m[2].replace('=', '==') if m[2] == '=' else m[2]} {m[3]})", where)
        code = re.sub(r":(\d+)", lambda m: f"v[{int(m[1]) - 1}]", where.replace(" AND ", " and ").replace(" OR ", " or "))
        with open(f"{self.folder}/rows.json") as f:
            rows = [r | {"day": r["day"] and dt.date.fromisoformat(r["day"])} for r in json.load(f)]
        self.left = [tuple(r[n] for n in names) for r in rows if eval(code, {"r": r, "v": values})]  # noqa: S307

    def fetchmany(self, n):
        out, self.left = self.left[:n], self.left[n:]
        return out


class Connection:
    def __init__(self, folder):
        self.folder = folder

    def cursor(self):
        return Cursor(self.folder)

    def close(self):
        pass


connect = Connection
