"""Runnable jobs: each has a run() that takes a session, and a command line that makes one."""
