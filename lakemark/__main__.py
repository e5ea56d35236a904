from lakemark.jobs import main

main()
