"""A board and a REST table on a local port, that can fail as told."""

import json
import threading
import urllib.parse
from http.server import BaseHTTPRequestHandler, ThreadingHTTPServer


class FakeWeb:
    def __init__(self):
        self.asked, self.fail, self.tables, self.merged, self.posts = [], {}, {}, [], 0
        self.broken_posts = []  # answers to give to the next requests that write
        self.sizes = {}
        outer = self

        class Handler(BaseHTTPRequestHandler):
            def log_message(self, *args):
                pass

            def answer(self, status, body=None):
                data = b"" if body is None else json.dumps(body).encode()
                self.send_response(status)
                self.send_header("Content-Length", str(len(data)))
                self.end_headers()
                self.wfile.write(data)

            def do_GET(self):
                q = dict(urllib.parse.parse_qsl(urllib.parse.urlsplit(self.path).query))
                with lock:
                    outer.asked.append((q["site"], q["country"], q["term"], int(q["offset"]), int(q["limit"])))
                    bad = outer.fail.get(q["term"])
                if bad:
                    return self.answer(bad, {"error": "no"})
                total = outer.sizes.get(q["term"], 0)
                at = range(int(q["offset"]), min(total, int(q["offset"]) + int(q["limit"])))
                rows = [{"id": f"{q['term']}-{k}", "title": "Optimization Engineer", "description": "gurobi", "job_url": f"http://x/{q['site']}/{q['country']}/{q['term']}/{k}", "is_remote": True, "date_posted": "2024-01-15"} for k in at]
                self.answer(200, {"total": total, "rows": rows})

            def do_POST(self):
                body = json.loads(self.rfile.read(int(self.headers["Content-Length"])))
                url = urllib.parse.urlsplit(self.path)
                with lock:
                    outer.posts += 1
                    if outer.broken_posts:
                        status = outer.broken_posts.pop(0)
                        if status:
                            return self.answer(status, {"error": "later"})
                    name = url.path.strip("/")
                    if name.startswith("rpc/"):
                        rows = [r for r in outer.tables.get("staging", {}).values() if r["run"] == body["run"]]
                        if len(rows) != body["rows"]:
                            return self.answer(409, {"error": f"{len(rows)} rows"})
                        outer.merged.append(body)
                        for r in rows:
                            outer.tables.setdefault("jobs", {})[r["job_id"],] = {k: v for k, v in r.items() if k != "run"}
                        outer.tables["staging"] = {k: r for k, r in outer.tables["staging"].items() if r["run"] != body["run"]}
                        return self.answer(200)
                    key = dict(urllib.parse.parse_qsl(url.query))["on_conflict"].split(",")
                    names = [tuple(r[k] for k in key) for r in body]
                    if len(set(names)) < len(names):
                        return self.answer(400, {"error": "a key twice"})
                    outer.tables.setdefault(name, {}).update(zip(names, body))
                self.answer(201)

            def do_DELETE(self):
                url = urllib.parse.urlsplit(self.path)
                run = dict(urllib.parse.parse_qsl(url.query))["run"].removeprefix("eq.")
                with lock:
                    name = url.path.strip("/")
                    outer.tables[name] = {k: r for k, r in outer.tables.get(name, {}).items() if r["run"] != run}
                self.answer(204)

        lock = threading.Lock()
        self.server = ThreadingHTTPServer(("127.0.0.1", 0), Handler)
        self.url = f"http://127.0.0.1:{self.server.server_port}"
        threading.Thread(target=self.server.serve_forever, daemon=True).start()

    def close(self):
        self.server.shutdown()
        self.server.server_close()
