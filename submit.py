"""Launcher for spark-submit: ``spark-submit --py-files spokewise.zip submit.py run --out …``."""

from spokewise.__main__ import main

if __name__ == "__main__":
    main()
