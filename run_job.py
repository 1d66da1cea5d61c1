"""Entry point for ``spark-submit run_job.py <job> <arguments>``."""

from gramrank.jobs import main

if __name__ == "__main__":
    main()
