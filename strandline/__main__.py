import sys

from strandline.session import local_session
from strandline.stages import main

main(local_session("*"), sys.argv[1:])
