"""Entry script for ``spark-submit``; see ``streamrank/jobs.py``."""

from streamrank.jobs import main

if __name__ == "__main__":
    main()
