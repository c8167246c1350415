"""A stand-in for a server with snapshots that can be exported: sqlite, and a file that says which snapshot is held."""

import os
import sqlite3


class Cursor:
    def __init__(self, server):
        self.server, self.rows, self.description = server, [], ("x",)

    def execute(self, sql, values=()):
        s, self.rows = self.server, []
        s.note(sql)
        if "pg_proc" in sql:
            self.rows = [(any(f"'{n}'" in sql for n in s.functions),)]
        elif "pg_try_advisory_lock" in sql:
            self.rows = [(s.free,)]
        elif "export_snapshot" in sql:
            self.rows = [("00A-1", 41 if "csn" in sql else None)]
        elif sql.startswith("SET TRANSACTION SNAPSHOT"):
            s.taken = sql
        elif "advisory" in sql or sql.startswith(("BEGIN", "ROLLBACK")):
            pass
        else:
            if not s.taken and s.strict:
                raise RuntimeError("read outside of the snapshot")
            self.inner = s.db.execute(sql.replace('"public".', ""))
            return
        self.inner = None

    def fetchall(self):
        return self.rows

    def fetchmany(self, n):
        return self.inner.fetchmany(n)

    def close(self):
        pass


class Server:
    def __init__(self, functions=(), free=True, strict=False):
        folder = os.environ["TIDEWIRE_STANDIN"]
        self.functions, self.free, self.strict, self.taken, self.log = functions, free, strict, None, f"{folder}/calls"
        self.db = sqlite3.connect(f"{folder}/db")

    def note(self, sql):
        with open(self.log, "a") as log:
            log.write(sql + "\n")

    def cursor(self):
        return Cursor(self)

    def close(self):
        self.note("CLOSE")
        self.db.close()


def best():
    return Server(("pg_export_snapshot_and_csn", "pg_current_csn"), strict=True)


def second():
    return Server(("pg_current_csn",))


def plain():
    return Server()


def busy():
    return Server(free=False)
