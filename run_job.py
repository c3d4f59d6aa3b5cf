"""Entry point for spark-submit; see tickloom/plans/jobs.py."""

from tickloom.plans.jobs import main

if __name__ == "__main__":
    main()
