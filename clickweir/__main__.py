import sys

from clickweir.cli import main

main(sys.argv[1:])
