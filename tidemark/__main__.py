from tidemark.cli import main

main()
