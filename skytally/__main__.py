import sys

from skytally.jobs import run
from skytally.session import build_session

if __name__ == "__main__":
    run(build_session("skytally"), sys.argv[1:])
