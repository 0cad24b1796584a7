import sys

from sigfleet.cli import main

main(sys.argv[1:])
