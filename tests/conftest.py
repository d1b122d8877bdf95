import http.server
import json
import os
import sys
import threading
from collections import Counter

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from pyspark.sql import SparkSession

    shared = tmp_path_factory.mktemp("shared")
    session = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "6g")
        .config("spark.ui.enabled", "false")
        .config("spark.checkpoint.dir", str(shared))
        .config("spark.sql.warehouse.dir", str(tmp_path_factory.mktemp("warehouse")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    return session


@pytest.fixture
def board_server(tmp_path):
    """A local server of boards that counts requests: a (5 rows: one without id, one twice), b (same title as a's first), broken (no list); all else is missing."""
    asked, answers = Counter(), {
        "/boards/a/jobs": {"jobs": [{"id": 3, "title": "T"}, {"title": "no id"}, {"id": 1, "title": "T"}, {"id": 2, "title": "B"}, {"id": 2, "title": "B"}]},
        "/boards/a/jobs/3": {"content": "&lt;p&gt;three&lt;/p&gt;"}, "/boards/a/jobs/2": {"content": "two"}, "/boards/a/jobs/7": {"id": 7, "title": "Seven", "content": "seven", "company": {"name": "Acme"}}, "/boards/b/jobs": {"jobs": []}, "/boards/broken/jobs": [],
    }

    class Handler(http.server.BaseHTTPRequestHandler):
        def do_GET(self):
            asked[self.path] += 1
            self.send_response(200 if self.path in answers else 404)
            self.end_headers()
            self.wfile.write(json.dumps(answers.get(self.path)).encode())

        def log_message(self, *_):
            pass

    server = http.server.ThreadingHTTPServer(("127.0.0.1", 0), Handler)
    threading.Thread(target=server.serve_forever, daemon=True).start()
    yield f"http://127.0.0.1:{server.server_port}", asked
    server.shutdown()
