"""Launcher for spark-submit: ``spark-submit [--conf ...] --py-files tessera.zip run_job.py <job> <in> <out> [args]``."""

from tessera.jobs import main

if __name__ == "__main__":
    main()
