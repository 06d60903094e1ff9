"""Runnable jobs: each module has a run() that takes a session, a command line, and its settings in a TOML file beside it."""
