"""Runnable plans: the registered queries, their reference SQL, and command-line jobs."""
