"""Script for spark-submit: ``spark-submit --py-files appmart.zip submit_pipeline.py --src DIR [--warehouse PATH]``."""

from appmart.__main__ import main

if __name__ == "__main__":
    main()
