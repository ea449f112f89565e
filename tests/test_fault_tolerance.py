"""A crawl task that fails is retried: pages are fetched again and emitted once."""

import os
import subprocess
import sys


def test_crawl_task_retry_emits_each_page_once(tmp_path):
    for n in range(1, 7):
        d = tmp_path / "pages" / f"page={n}"
        d.mkdir(parents=True)
        (d / "part-00000.txt").write_text(f'[{{"id": "{n}"}}]\n')
    marker = tmp_path / "failed-once"
    job = os.path.join(os.path.dirname(__file__), "retry_job.py")
    out = subprocess.run([sys.executable, job, "crawl", str(tmp_path / "pages"), str(marker)],
                         capture_output=True, text=True, timeout=600)
    assert out.returncode == 0, out.stderr[-2000:]
    assert marker.exists()                                   # a failure did happen
    assert "PAGES [1, 2, 3, 4, 5, 6]" in out.stdout


def test_flow_counts_not_doubled_by_a_retried_stage(tmp_path):
    marker = tmp_path / "failed-once"
    job = os.path.join(os.path.dirname(__file__), "retry_job.py")
    out = subprocess.run([sys.executable, job, "flow", str(tmp_path / "lake"), str(marker)],
                         capture_output=True, text=True, timeout=600)
    assert out.returncode == 0, out.stderr[-2000:]
    assert marker.exists()
    assert "COUNTS 3000 3000 7 3000" in out.stdout


def test_job_wrapper_owns_and_stops_its_session(tmp_path):
    job = os.path.join(os.path.dirname(__file__), "owned_session_job.py")
    out = subprocess.run([sys.executable, job, str(tmp_path / "lake")],
                         capture_output=True, text=True, timeout=600)
    assert out.returncode == 0, out.stderr[-2000:]
    assert "COUNTS 300 300 3" in out.stdout            # cluster profile settings are accepted
    assert "STOPPED True" in out.stdout
