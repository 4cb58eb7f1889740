"""Launcher for spark-submit (which takes a file, not a module):

    spark-submit --py-files reelframe.zip export_jobs.py --csv hdfs:///data/films.csv --out hdfs:///out/films
"""

from reelframe.__main__ import main

if __name__ == "__main__":
    main()
